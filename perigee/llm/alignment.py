"""Alignment of two tokenizers over the same texts, through anchors: bytes at which a token of each starts.

A text is tokenised whole by both, and both must spell it. The starts of either side's tokens are
marked on a map of the text's bytes. Where both are marked (at nearly every space, and inside words)
is an anchor: the tokens before it end together there. The window between an anchor and the next is
a group, and every mark in it, its own anchor's included, starts one link: that of the two tokens
that cover this byte. All texts of a chunk lie on one map, so nothing goes token by token.

1. One scan tokenises, aligns, and stores for every document its figures, and its distinct links
   with their numbers, ascending and as differences. Each task adds up the links of its documents
   and stores those sums as well, whenever it holds many.
2. The sums of the tasks give the count of each id pair in the corpus, and the highest count of
   each id of B.
3. The pair table is looked through in blocks of whole B ids, at most ``BLOCK`` pairs each unless a
   single id has more (it has no more than A has ids). A block goes to all tasks, each document's
   links of that block are looked up, and its remaining links are stored for the next block.
   Nothing is shuffled but the sums of the tasks, and what a task holds doesn't grow with the corpus.

A is byte-level BPE from a .json file. Its ids are also found by another library, which is faster,
for texts of plain characters, if the file's merges stand in the order of their ids.

Defined results. Texts that are null or empty, or whose tokens' joined bytes of either side differ
from space and text (for example those with U+2581, or of characters B doesn't know), have no
tokens: zeros and an empty digest. Null doc_id: kept. Repeated rows: each comes out and each
counts. Ties for the highest count all count as highest. Empty table: no rows. Extra columns are
ignored. Texts of any length are aligned whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import chunks_by_length, stored

#: Id pairs looked up at once: 17 bytes each, sent to all tasks.
BLOCK = 1 << 20
#: Links a task holds, of some chunks each, before it adds them up; with over half as many then left it stores the sums.
REMEMBERED = 1 << 20
#: Characters tokenised at once.
CHARS = 1 << 19
_PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\\u00a1-\\u017f\\u2010-\\u2027\\u20ac]*")
# Fixed value: how byte-level BPE splits text before merging.
_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: printable Latin-1 stands for itself, other bytes follow from U+0100."""
    itself = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(itself)]
    return {chr(b): b for b in itself} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokens:
    """Side A: byte-level BPE."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["id"]: t["content"] for t in spec["added_tokens"]}
        vocabulary = spec["model"]["vocab"]
        alphabet = byte_alphabet()
        self.bytes = [b""] * (max([*vocabulary.values(), *special]) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = token.encode() if i in special else bytes(alphabet[c] for c in token)
        self.fast = self._fast(spec, {i for i in vocabulary.values() if i not in special})

    def _fast(self, spec: dict, ids: set):
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        vocabulary = spec["model"]["vocab"]
        in_order = all(vocabulary.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)) and len(ids) == 256 + len(merges)
        step = spec["pre_tokenizer"] or {}
        if not in_order or spec["normalizer"] or step.get("type") != "ByteLevel" or step.get("add_prefix_space") or not step.get("use_regex", True):
            return None
        import tiktoken

        return tiktoken.Encoding("ordered-merges", pat_str=_SPLIT, mergeable_ranks={self.bytes[i]: i for i in ids}, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.fast is None:
            return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [self.fast.encode_ordinary(t) if _PLAIN.fullmatch(t) else self.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


class PieceTokens:
    """Side B: pieces with a mark for spaces and bytes as a last resort; it adds the first space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        pieces = self.model.id_to_piece(list(range(size)))
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each number below n: its decimal digits, at most seven, as the low bytes of a word, and how many bits these fill."""
    if n > 10**7:
        raise ValueError(f"{n} ids don't fit seven digits")
    digits = np.array([int.from_bytes(str(i).encode(), "little") for i in range(n)], np.uint64)
    return digits, np.array([8 * len(str(i)) for i in range(n)], np.uint64)


class Aligner:
    """Both tokenizers and the links met so far. A link is known by code = b * (ids of A) + a."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self.sizes = [np.array([len(t) for t in side.bytes], np.int64) for side in (self.a, self.b)]
        self.width, self.height = len(self.a.bytes), len(self.b.bytes)
        self.names = [_decimals(n) for n in (self.width, self.height)]
        self.forget()

    def forget(self) -> None:
        self.met: list = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        self.held = 0

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Codes and numbers of all links met since the last :meth:`forget`, which follows."""
        self.merge()
        ((codes, n),) = self.met
        self.forget()
        return codes, n

    def merge(self) -> None:
        """Adds up the links of the chunks met."""
        self.met = [_added(*map(np.concatenate, zip(*self.met, strict=True)))]
        self.held = len(self.met[0][0])

    def tokens(self, texts: list[str]) -> tuple[list, list]:
        """Ids of both sides, none where the joined bytes of either differ from space and text."""
        given = [t for t in texts if t]
        found = iter(zip(given, self.a.encode([" " + t for t in given]), self.b.encode(given), strict=True))
        out_a, out_b = [], []
        for text in texts:
            a, b = [], []
            if text:
                _, a, b = next(found)
                wanted = b" " + text.encode("utf-8", "surrogatepass")
                if any(b"".join(map(side.bytes.__getitem__, ids)) != wanted for side, ids in ((self.a, a), (self.b, b))):
                    a, b = [], []
            out_a.append(a)
            out_b.append(b)
        return out_a, out_b

    def documents(self, texts: list[str]) -> dict:
        """Figures, digests and links of some documents; their links are met."""
        lists = self.tokens(texts)
        counts = [np.array([len(x) for x in side], np.int64) for side in lists]
        ids = [np.fromiter(chain.from_iterable(side), np.int64, int(n.sum())) for side, n in zip(lists, counts, strict=True)]
        starts = [np.cumsum(n := size[i]) - n for size, i in zip(self.sizes, ids, strict=True)]
        n_bytes = int(self.sizes[0][ids[0]].sum())
        marks = [np.zeros(n_bytes, bool) for _ in starts]
        for mark, start in zip(marks, starts, strict=True):
            mark[start] = True
        anchors, links = marks[0] & marks[1], np.flatnonzero(marks[0] | marks[1])
        group = [np.cumsum(anchors[start]) - 1 for start in starts]
        n_groups = np.count_nonzero(anchors)
        token_a, token_b = (np.cumsum(mark[links]) - 1 for mark in marks)
        codes = ids[1][token_b] * self.width + ids[0][token_a]
        # a document's first token of either side, first byte, link and group, and after the last document their numbers
        first = [np.concatenate([[0], np.cumsum(n)]) for n in counts]
        first_link = np.searchsorted(links, np.append(starts[0], n_bytes)[first[0]])
        first_group = np.append(group[0], n_groups)[first[0]]
        text, edges = self.spelled(ids, group, n_groups, first)
        digests = [hashlib.sha256(text[start:stop]).hexdigest() if stop > start else "" for start, stop in pairwise(edges)]
        n_links = np.diff(first_link)
        owner = np.arange(len(texts) + 1) * (self.width * self.height)
        keyed, times = _runs(np.sort(np.repeat(owner[:-1], n_links) + codes))
        offsets = np.searchsorted(keyed, owner)
        keyed -= np.repeat(owner[:-1], np.diff(offsets))
        self.met.append(_added(keyed, times))
        self.held += len(self.met[-1][0])
        return {
            "n_a": counts[0], "n_b": counts[1], "n_groups": np.diff(first_group), "n_links": n_links,
            "groups_sha256": digests, "offsets": offsets, "codes": keyed, "times": times,
        }

    def spelled(self, ids: list, group: list, n_groups: int, first: list) -> tuple[bytes, list]:
        """Groups as text, documents one after the other, and where the text of each starts and that of the last ends."""
        size = [np.bincount(g, minlength=n_groups) for g in group]
        upto = [np.cumsum(n) for n in size]
        # tokens stand group by group, those of A before those of B
        places = (np.arange(len(ids[0])) + (upto[1] - size[1])[group[0]], np.arange(len(ids[1])) + upto[0][group[1]])
        words = np.zeros(len(ids[0]) + len(ids[1]), np.uint64)
        for side, last in enumerate("|;"):
            mark = np.full(len(ids[side]), ord(","), np.uint64)
            mark[upto[side] - 1] = ord(last)
            if last == ";":
                mark[first[1][1:][np.diff(first[1]) > 0] - 1] = 0
            digits, bits = (column[ids[side]] for column in self.names[side])
            words[places[side]] = digits | mark << bits
        letters = words.astype("<u8").view(np.uint8)
        used = letters != 0
        length = np.count_nonzero(used.reshape(-1, 8), axis=1)
        return letters[used].tobytes(), np.concatenate([[0], np.cumsum(length)])[first[0] + first[1]].tolist()


def _runs(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an ascending array and how often each stands there."""
    start = np.flatnonzero(np.diff(ascending, prepend=-1))
    return ascending[start], np.diff(start, append=len(ascending))


def _added(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, and the sum of n of each."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    start = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[start], np.add.reduceat(n[order], start) if len(start) else n[:0]


def _differences(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Codes that ascend within each document as the first and the steps from one to the next."""
    out = np.diff(codes, prepend=0)
    first = offsets[:-1][offsets[1:] > offsets[:-1]]
    out[first] = codes[first]
    return out


def _summed(steps: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.cumsum(steps)
    before = np.concatenate([[0], total])[offsets[:-1]]
    return total - np.repeat(before, np.diff(offsets))


def _lists(values: np.ndarray, offsets: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


_FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
_DOCUMENT = pa.schema(
    [("doc_id", pa.int64()), *((c, pa.int64()) for c in _FIGURES), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string()), ("steps", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))]
)
_DOCUMENT_SQL = "doc_id long, " + ", ".join(f"{c} long" for c in _FIGURES) + ", n_best long, count_sum long, groups_sha256 string, steps array<long>, times array<int>"
_aligners: dict = {}


def _aligning(path_a: str, path_b: str):
    """Documents with their links, and rows with the codes and numbers of all links of the task."""
    schema = pa.schema([*_DOCUMENT, ("code", pa.int64()), ("n", pa.int64())])

    def sums(aligner):
        codes, n = aligner.sums()
        for at in range(0, len(codes), 100_000):
            part = codes[at : at + 100_000]
            filled = {"code": pa.array(part), "n": pa.array(n[at : at + 100_000])}
            yield pa.RecordBatch.from_arrays([filled.get(f.name, pa.nulls(len(part), f.type)) for f in schema], schema=schema)

    def run(batches):
        if (path_a, path_b) not in _aligners:
            _aligners[path_a, path_b] = Aligner(path_a, path_b)
        aligner = _aligners[path_a, path_b]
        aligner.forget()  # a worker may have left some from a task that failed
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for start, stop in chunks_by_length(texts, CHARS):
                found = aligner.documents(texts[start:stop])
                offsets, rows = found["offsets"], stop - start
                columns = [batch.column("doc_id").slice(start, rows), *(pa.array(found[c]) for c in _FIGURES), pa.array(np.zeros(rows, np.int64)), pa.array(np.zeros(rows, np.int64))]
                columns += [pa.array(found["groups_sha256"], pa.string()), _lists(_differences(found["codes"], offsets), offsets, pa.int64()), _lists(found["times"], offsets, pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64())], schema=schema)
                if aligner.held > REMEMBERED:
                    aligner.merge()
                    if aligner.held > REMEMBERED // 2:
                        yield from sums(aligner)
        yield from sums(aligner)

    return run


def _looked_up(table):
    """Adds the counts of a block of the pair table to documents and takes the links of that block from their lists."""

    def run(batches):
        known, counts, best, upto = table.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                steps, times = part.column("steps"), part.column("times")
                offsets = steps.offsets.to_numpy().astype(np.int64)
                offsets = offsets - offsets[0]
                codes = _summed(steps.flatten().to_numpy(), offsets)
                times = times.flatten().to_numpy().astype(np.int64)
                here = codes < upto
                found = np.searchsorted(known, codes[here])
                n = times[here]
                owner = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                total = lambda x, own: np.diff(np.concatenate([[0], np.cumsum(x)])[np.searchsorted(own, np.arange(part.num_rows + 1))])
                left = np.searchsorted(owner[~here], np.arange(part.num_rows + 1))
                changed = {
                    "n_best": pa.array(part.column("n_best").to_numpy() + total(n * best[found], owner[here])),
                    "count_sum": pa.array(part.column("count_sum").to_numpy() + total(n * counts[found], owner[here])),
                    "steps": _lists(_differences(codes[~here], left), left, pa.int64()),
                    "times": _lists(times[~here], left, pa.int32()),
                }
                columns = [changed[f.name] if f.name in changed else part.column(f.name) for f in _DOCUMENT]
                yield pa.RecordBatch.from_arrays(columns, schema=_DOCUMENT)

    return run


def pair_counts(sums: DataFrame, width: int) -> DataFrame:
    """b, code, n (links of the id pair in the whole corpus) and best (whether no pair of that id of B has more)."""
    counts = sums.groupBy("code").agg(F.sum("n").alias("n")).withColumn("b", F.expr(f"code div {width}"))
    counts = stored(counts, "aligned-pairs")
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))  # at most a row for each id of B
    return counts.join(F.broadcast(highest), "b").select("b", "code", "n", (F.col("n") == F.col("highest")).alias("best"))


def blocks(pairs: DataFrame, block: int) -> list[tuple[int, int]]:
    """Ranges [from, to) of B ids with at most ``block`` pairs each, unless one id alone has more."""
    sizes = sorted(pairs.groupBy("b").count().collect())  # at most a row for each id of B
    out, start, held = [], 0, 0
    for b, n in sizes:
        if held and held + n > block:
            out.append((start, b))
            start, held = b, 0
        held += n
    return [*out, (start, sizes[-1][0] + 1 if sizes else 1)]


def alignments(docs: DataFrame, path_a: str, path_b: str, block: int | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    width = len(ByteTokens(path_a).bytes)
    wanted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = stored(wanted.mapInArrow(_aligning(path_a, path_b), _DOCUMENT_SQL + ", code long, n long"), "aligned")
    rows = found.where("code is null").drop("code", "n")
    pairs = pair_counts(found.where("code is not null").select("code", "n"), width)
    ranges = blocks(pairs, block or BLOCK)
    for k, (start, stop) in enumerate(ranges):
        part = pairs.where((F.col("b") >= start) & (F.col("b") < stop)).select("code", "n", "best").orderBy("code").toArrow()
        table = spark.sparkContext.broadcast((*(part.column(c).to_numpy() for c in ("code", "n", "best")), stop * width))
        rows = rows.mapInArrow(_looked_up(table), _DOCUMENT_SQL)
        if k + 1 < len(ranges):
            rows = stored(rows, "aligned-rest")
            table.unpersist()
    return rows.drop("steps", "times")

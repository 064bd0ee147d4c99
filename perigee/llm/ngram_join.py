"""Jaccard self-join of documents over word n-grams, with prefix filters under several orders.

Two sets that are similar enough share a token among the first few of each, whatever order all
sets are sorted by. Three global orders are used at once: by frequency (frequent last), and by two
hashes of the tokens. Buckets of the first order propose pairs; a pair must then also share a
prefix token under the other two; only then are whole sets compared.

1. Documents with equal sets form a class; classes are what is joined.
2. How frequent a token is comes from a sketch of fixed size that counts the tokens of all
   documents. Any function of the token gives a valid order, so only speed depends on it.
3. In a bucket of up to ``BUCKET`` members all pairs are proposed whose sizes, positions and parity
   bitmaps allow the required overlap: every token that only one of two sets has flips one bit, so
   more differing bits than tokens may differ rule a pair out. In a larger bucket, members pair
   with the bucket's leader, the member in which that token stands first, so a group of near copies
   costs its size, not its square.
4. For every class one proposed pair is compared first, and components are formed from the
   links. Then follow the proposed pairs between components, and the members of large buckets
   that are not in their leader's component: blocks of them meet blocks of all members, and only
   pairs of different components whose wide parities allow a link leave the task: first one pair
   for each such member, which joins most of what belongs together, then, with the components that
   these made, all others. Pairs inside a component can't change it, so no link that matters is lost.

Tokens are 64-bit hashes of n-grams and a class is known by a 64-bit hash of its set; two of
10**8 different sets get the same hash with probability 0.0003. Whole sets are compared by the upper
48 bits of their tokens, see :func:`_packed`.

Defined results. Null or blank text: no n-grams, linked with nothing. Fewer words than n: the
whole sequence is the one n-gram. Null doc_id: the row is kept; its component is the smallest
non-null doc_id reachable, else null. Repeated rows come out once each. An empty table gives an
empty result. Extra columns are ignored. Texts of any length are used whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from perigee.llm.common import chunks_by_length, mix64, stored
from perigee.llm.components import components

#: Counters of the sketch, as a power of two: 16 MB broadcast. With many tokens to a counter,
#: only tokens that stand out from the rest still count as frequent.
SKETCH_BITS = 22
SKETCH_BLOCK = 1 << 16
#: A token counts as frequent from so many documents on, beyond what its counter holds of others.
FREQUENT_FROM = 32
#: Parity bitmap of a posting (384 places), and the larger one by which proposed pairs are checked.
PARITY = [f"p{i}" for i in range(6)]
WIDE_PARITY = 2048
#: Rows of one frequent token that go to one task while buckets are looked through.
ROWS_PER_SALT = 1 << 16
#: Members up to which a bucket is compared all with all at once; larger ones go by their leader first.
BUCKET = 64
#: Members of a large bucket on either side of one block, and pairs looked at together.
SIDE = 2048
CELLS = 1 << 17
#: Least and largest size of the filter of ids by which documents are chosen for comparison where
#: they lie, as powers of two: 32 MB broadcast at most, eight places an id up to 32 M ids. It only
#: saves work; ids it lets through wrongly are joined away.
FILTER_BITS = (20, 28)
#: Seeds of the hashes by which the second and third order sort tokens.
ORDERS = (11, 12)


def token_sets(texts: list, n: int):
    """Sorted distinct 64-bit n-gram hashes of every text. Words are split at ASCII white space, A-Z lower-cased."""
    places = [pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1 for i in range(n)]
    for start, stop in chunks_by_length(texts, 1 << 20):
        words, ends = [], []
        for t in texts[start:stop]:
            words += t.encode("utf-8", "surrogatepass").lower().split()
            ends.append(len(words))
        h = pd.util.hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, np.uint64)
        m = max(0, len(h) - n + 1)
        acc = np.zeros(m, np.uint64)
        for i, k in enumerate(places):
            acc += h[i : m + i] * np.uint64(k)
        grams = mix64(acc, n)
        at = 0
        for end in ends:
            if end - at >= n:
                yield np.unique(grams[at : end - n + 1])
            elif end > at:
                few = sum(int(w) * k for w, k in zip(h[at:end], places, strict=False)) & 0xFFFFFFFFFFFFFFFF
                yield mix64(np.array([few], np.uint64), 100 + end - at)
            else:
                yield np.zeros(0, np.uint64)
            at = end


def set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_length(size: int, num: int, den: int) -> int:
    return size + 1 + (-num * size) // den


def _batches(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            cols = batch.slice(at, 1000).to_pydict()
            yield cols["doc_id"], [t or "" for t in cols["text"]]


def _parity(tokens: np.ndarray, places: int) -> np.ndarray:
    """For each of so many places whether an odd number of tokens falls on it, as 64-bit integers."""
    odd = np.bincount((tokens % np.uint64(places)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefix(tokens: np.ndarray, p: int, seed: int) -> np.ndarray:
    """The first p tokens by a hash of their own, as 32 bits of it."""
    hashed = mix64(tokens, seed)
    if p < len(hashed):
        hashed = np.partition(hashed, p - 1)[:p]
    return hashed.astype(np.uint32).view(np.int32)


def _signatures(n: int, num: int, den: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sid", pa.int64()), ("low", pa.list_(pa.int32())), ("high", pa.list_(pa.int32()))]
                       + [(p, pa.int64()) for p in PARITY] + [("wide", pa.list_(pa.int64())), ("block", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        seen = set()  # classes of this partition
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        for ids, texts in _batches(batches):
            rows = {c: [] for c in schema.names}
            for doc_id, s in zip(ids, token_sets(texts, n), strict=True):
                sid = set_id(s) if len(s) else None
                new = sid is not None and sid not in seen
                p = prefix_length(len(s), num, den)
                for c, v in zip(schema.names, (doc_id, len(s), sid, *(_prefix(s, p, seed) if new else None for seed in ORDERS),
                                               *(_parity(s, 64 * len(PARITY)).tolist() if new else [None] * len(PARITY)),
                                               _parity(s, WIDE_PARITY) if new else None, None, None), strict=True):
                    rows[c].append(v)
                if new:
                    seen.add(sid)
                    np.add.at(sketch, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
            yield pa.RecordBatch.from_pydict(rows, schema=schema)
        if seen:
            blocks = np.minimum(sketch, 0xFFFF).astype("<u2").reshape(-1, SKETCH_BLOCK)
            rows = {c: [None] * len(blocks) for c in schema.names}
            rows["block"], rows["counts"] = list(range(len(blocks))), [b.tobytes() for b in blocks]
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    return run


def _added(kind: str):
    """The sums of the sketch blocks of one partition, of which the counts are of that type."""
    schema = pa.schema([("block", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        sums: dict = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total = sums.setdefault(block, np.zeros(SKETCH_BLOCK, np.uint32))
                total += np.minimum(np.frombuffer(counts.as_buffer(), kind), 0xFFFFFFFF - total)
        for block, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.astype("<u4").tobytes()], pa.binary())], schema=schema)

    return run


def _postings(n: int, num: int, den: int, frequent):
    schema = pa.schema([("token", pa.int64()), ("salt", pa.int32()), ("sid", pa.int64()), ("pos", pa.int32())])

    def run(batches):
        sketch, often = frequent.value
        seen = set()
        for _, texts in _batches(batches):
            out = [[] for _ in schema.names]

            def flush(out=out):
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), f.type) for x, f in zip(out, schema, strict=True)], schema=schema)

            rows = 0
            for s in token_sets(texts, n):
                if not len(s) or (sid := set_id(s)) in seen:
                    continue
                seen.add(sid)
                p = prefix_length(len(s), num, den)
                level = sketch[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                # by counted frequency, then by hash: s ascends, and sorting keeps equal ones in place
                within = np.flatnonzero(level <= np.partition(level, p - 1)[p - 1])
                first = within[np.argsort(level[within], kind="stable")[:p]]
                split = level[first].astype(np.int64) // ROWS_PER_SALT + 1
                salt = np.where(level[first] < often, -1, np.where(split > 1, 1 + sid % split, 0)).astype(np.int32)
                k = len(first)
                for x, v in zip(out, (s[first].view(np.int64), salt, np.full(k, sid, np.int64), np.arange(k, dtype=np.int32)), strict=True):
                    x.append(v)
                rows += k
                if rows > 200_000:
                    yield flush()
                    for x in out:
                        x.clear()
                    rows = 0
            if rows:
                yield flush()

    return run


def _shared(batches):
    """Of postings sorted by token, those whose token stands in more than one class; salted ones all."""
    kept = None  # rows of the token at the batch's end, all of one class so far
    shared, last = False, None  # whether that token is known to be shared
    for batch in batches:
        if batch.num_rows == 0:
            continue
        part = pa.Table.from_batches([batch])
        if kept is not None:
            part = pa.concat_tables([kept, part])
        token, sid, salt = (part[c].to_numpy() for c in ("token", "sid", "salt"))
        first = np.concatenate([[True], token[1:] != token[:-1]])
        group = np.cumsum(first) - 1
        lead = sid[first][group]
        differs = np.zeros(group[-1] + 1, bool)
        differs[group[sid != lead]] = True
        differs[group[salt > 0]] = True
        if kept is None and shared and token[0] == last:
            differs[0] = True
        last = token[-1]
        shared = bool(differs[-1])
        live = differs[group]
        kept = None if shared else part.filter(pa.array(group == group[-1]))
        if live.any():
            yield from part.filter(pa.array(live)).combine_chunks().to_batches()


class _Members:
    """Postings as arrays, and which pairs of them may be linked and are not proposed in an earlier bucket."""

    def __init__(self, table: pa.Table, num: int, den: int, parity):
        take = lambda c: table[c].to_numpy()
        self.token, self.sid, self.n, self.pos = take("token"), take("sid"), take("n"), take("pos").astype(np.int64)
        previous = table["previous"]
        self.first, self.previous = previous.is_null().to_numpy(), previous.fill_null(0).to_numpy()
        self.num, self.den = num, den
        if isinstance(parity, str):
            flat = table[parity].combine_chunks()
            self.parity = flat.flatten().to_numpy().reshape(table.num_rows, -1)
        else:
            self.parity = np.column_stack([take(c) for c in parity])
        self.parity = self.parity.view(np.uint64)  # bits of a signed integer are counted of its absolute value

    def may_link(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        both = self.n[i] + self.n[j]
        most = np.minimum(self.n[i] - self.pos[i], self.n[j] - self.pos[j])
        fits = most * (self.num + self.den) >= both * self.num
        fits &= (self.previous[i] != self.previous[j]) | self.first[i] | self.first[j]
        i, j, both = i[fits], j[fits], both[fits]
        differ = np.bitwise_count(self.parity[i] ^ self.parity[j]).sum(axis=1, dtype=np.int64)
        fits = (both - differ) * (self.num + self.den) >= both * (2 * self.num)
        return i[fits], j[fits]


_PAIR = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _pairs_of(members: _Members, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    a, b = members.sid[i], members.sid[j]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=_PAIR)


def _whole_groups(batches, key: str):
    """The rows of a sorted partition in tables that never cut a group of equal keys."""
    kept = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        part = pa.Table.from_batches([batch])
        if kept is not None:
            part = pa.concat_tables([kept, part])
        values = part[key].to_numpy()
        last = int(np.searchsorted(values == values[-1], True))  # where the last group starts, as it may go on
        kept = part.slice(last)
        if last:
            yield part.slice(0, last).combine_chunks()
    if kept is not None:
        yield kept.combine_chunks()


def _near(num: int, den: int):
    """Of buckets of up to ``BUCKET`` members, sorted by token, all pairs that may be linked."""

    def run(batches):
        for table in _whole_groups(batches, "token"):
            members = _Members(table, num, den, PARITY)
            start = np.arange(len(members.token))
            step = 1
            while len(start):  # pairs of rows that lie step apart in one bucket
                start = start[start + step < len(members.token)]
                start = start[members.token[start] == members.token[start + step]]
                for at in range(0, len(start), CELLS):
                    i = start[at : at + CELLS]
                    yield _pairs_of(members, *members.may_link(i, i + step))
                step += 1

    return run


def _across(num: int, den: int, one: bool):
    """Of blocks of a large bucket: pairs of a member left of the block and one right of it, in different components.

    ``one``: of each left member only the pair with the first right one, by place of the token, so
    that many of them choose the same.
    """

    def run(batches):
        for table in _whole_groups(batches, "block"):
            members = _Members(table, num, den, "wide")
            root, head, left, block = (table[c].to_numpy(zero_copy_only=False) for c in ("root", "head", "is_left", "block"))
            edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                x, y = a + np.flatnonzero(left[a:b]), a + np.flatnonzero(~left[a:b])
                y = y[np.lexsort((members.sid[y], members.pos[y]))]
                rows = max(1, CELLS // max(1, len(y)))
                for at in range(0, len(x), rows):
                    i = np.repeat(x[at : at + rows], len(y))
                    j = np.tile(y, len(x[at : at + rows]))
                    apart = root[i] != root[j]
                    if not one:  # both may stand outside the leader's component: then each is left of the other once
                        apart &= (root[j] == head[j]) | (members.sid[i] < members.sid[j])
                    i, j = members.may_link(i[apart], j[apart])
                    if one:
                        i, first = np.unique(i, return_index=True)
                        j = j[first]
                    yield _pairs_of(members, i, j)

    return run


def _packed(tokens: np.ndarray) -> bytes:
    """Tokens by their upper 48 bits, six bytes each. Two sets of 1 000 tokens show a wrong common one once in 10**8 pairs."""
    return np.ascontiguousarray(tokens.view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _unpacked(packed) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _overlaps(batches):
    """Pairs with their two sets: the size of the intersection."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("nu", pa.int64()), ("nv", pa.int64()), ("common", pa.int64())])
    for batch in batches:
        u, v, a, b = (batch.column(c) for c in ("u", "v", "set_u", "set_v"))
        a, b = ([_unpacked(x.as_buffer()) for x in c] for c in (a, b))
        common = [len(np.intersect1d(x, y)) for x, y in zip(a, b, strict=True)]
        yield pa.RecordBatch.from_arrays([u, v, pa.array([len(x) for x in a], pa.int64()), pa.array([len(x) for x in b], pa.int64()), pa.array(common, pa.int64())], schema=schema)


def _places(ids: np.ndarray, size: int) -> np.ndarray:
    return (mix64(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - size)).astype(np.int64)


def _marked(size: int):
    """For the filter of ids: words of 63 bits with the bits of the ids that are not null."""
    schema = pa.schema([("word", pa.int64()), ("bits", pa.int64())])

    def run(batches):
        for batch in batches:
            at = _places(batch.column("id").drop_null().to_numpy(zero_copy_only=False), size)
            yield pa.RecordBatch.from_arrays([pa.array(at // 63), pa.array(np.int64(1) << (at % 63))], schema=schema)

    return run


def _sets(n: int, wanted, size: int):
    """The sets of the documents whose ids the filter lets through, and of those without an id."""
    schema = pa.schema([("doc_id", pa.int64()), ("found", pa.int64()), ("tokens", pa.binary())])

    def run(batches):
        bits = wanted.value
        for batch in batches:
            ids = batch.column("doc_id")
            at = _places(ids.fill_null(0).to_numpy(zero_copy_only=False), size)
            passes = (bits[at // 63] >> (at % 63)) & 1 == 1
            batch = batch.filter(pa.array(passes | ids.is_null().to_numpy(zero_copy_only=False)))  # few are left
            ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            rows = {c: [] for c in schema.names}
            for doc_id, s in zip(ids, token_sets(texts, n), strict=True):
                rows["doc_id"].append(doc_id)
                rows["found"].append(set_id(s) if len(s) else None)
                rows["tokens"].append(_packed(s))
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    return run


class _Join:
    def __init__(self, docs: DataFrame, n: int, num: int, den: int):
        self.spark, self.n, self.num, self.den = docs.sparkSession, n, num, den
        self.docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        kinds = "doc_id long, n long, sid long, low array<int>, high array<int>, " + ", ".join(f"{p} long" for p in PARITY) + ", wide array<long>"
        found = self.docs.mapInArrow(_signatures(n, num, den), kinds + ", block int, counts binary")
        written = stored(found, "ngram-signatures")
        self.signed = written.where("block is null").drop("block", "counts")
        self.sketched = written.where("block is not null").select("block", "counts")

    def frequent(self):
        """The sketch of all documents' tokens, and the count from which a token is frequent, for all tasks."""
        kinds = self.sketched.schema
        parts = self.sketched.coalesce(8).mapInArrow(_added("<u2"), kinds).repartition(32, "block").mapInArrow(_added("<u4"), kinds).toArrow()
        sketch = np.zeros((1 << SKETCH_BITS) // SKETCH_BLOCK * SKETCH_BLOCK, np.uint32)
        for block, counts in zip(parts.column(0).to_pylist(), parts.column(1).to_pylist(), strict=True):
            sketch[block * SKETCH_BLOCK : (block + 1) * SKETCH_BLOCK] = np.frombuffer(counts, "<u4")
        others = float(sketch.mean())
        return self.spark.sparkContext.broadcast((sketch, FREQUENT_FROM + others + 4 * others**0.5))

    def feasible(self, x: str, y: str):
        """Whether sets of which the first common token stands at these positions, with these parities, can overlap enough."""
        both = F.col(f"{x}.n") + F.col(f"{y}.n")
        most = F.least(F.col(f"{x}.n") - F.col(f"{x}.pos"), F.col(f"{y}.n") - F.col(f"{y}.pos"))
        differ = sum((F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}"))) for p in PARITY), F.lit(0))
        return (most * (self.num + self.den) >= both * self.num) & ((both - differ) * (self.num + self.den) >= both * (2 * self.num))

    @staticmethod
    def pairs(joined: DataFrame) -> DataFrame:
        a, b = F.col("x.sid"), F.col("y.sid")
        return joined.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct()

    def agree(self, pairs: DataFrame) -> DataFrame:
        """Pairs that also share a prefix token under both hash orders, and whose wide parities allow the overlap."""
        ends = pairs.select(F.col("u").alias("sid")).unionByName(pairs.select(F.col("v").alias("sid"))).distinct()
        known = self.signed.where("low is not null").select("sid", "n", "low", "high", "wide")
        known = known.join(ends, "sid", "left_semi").dropDuplicates(["sid"])
        u, v = (known.select(F.col("sid").alias(e), *[F.col(c).alias(f"{c}_{e}") for c in ("n", "low", "high", "wide")]) for e in "uv")
        both = F.arrays_overlap("low_u", "low_v") & F.arrays_overlap("high_u", "high_v")
        flips = F.zip_with("wide_u", "wide_v", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        size, differ = F.col("n_u") + F.col("n_v"), F.aggregate(flips, F.lit(0), lambda total, x: total + x)
        near = (size - differ) * (self.num + self.den) >= size * (2 * self.num)
        return pairs.join(u, "u").join(v, "v").where(both & near).select("u", "v")

    def linked(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs whose whole sets are similar enough."""
        ends = pairs.select(F.col("u").alias("sid")).unionByName(pairs.select(F.col("v").alias("sid")))
        sets = self.sets_of(ends, classes)
        u = sets.select(F.col("sid").alias("u"), F.col("tokens").alias("set_u"))
        v = sets.select(F.col("sid").alias("v"), F.col("tokens").alias("set_v"))
        counted = pairs.join(v, "v").join(u, "u").select("u", "v", "set_u", "set_v").mapInArrow(_overlaps, "u long, v long, nu long, nv long, common long")
        return counted.where(F.col("common") * self.den >= self.num * (F.col("nu") + F.col("nv") - F.col("common"))).select("u", "v")

    def sets_of(self, sids: DataFrame, classes: DataFrame) -> DataFrame:
        need = classes.join(sids.distinct(), "sid", "left_semi").select("sid", F.col("first_id").alias("id"))
        need = stored(need, "ngram-needed")
        size = min(max(8 * need.count(), 1).bit_length(), FILTER_BITS[1])
        size = max(size, FILTER_BITS[0])
        marked = need.mapInArrow(_marked(size), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        bits = np.zeros((1 << size) // 63 + 1, np.int64)
        bits[marked.column("word").to_numpy()] = marked.column("bits").to_numpy()
        wanted = self.spark.sparkContext.broadcast(bits)
        found = self.docs.mapInArrow(_sets(self.n, wanted, size), "doc_id long, found long, tokens binary")
        back = found.join(need, found["found"] == need["sid"]).where(F.col("doc_id").eqNullSafe(F.col("id")))
        sets = stored(back.select("sid", "tokens").dropDuplicates(["sid"]), "ngram-sets", release=True)
        wanted.destroy()
        return sets

    def links(self, classes: DataFrame) -> DataFrame:
        """Links (u, v) between classes that span every component."""
        frequent = self.frequent()
        made = self.docs.mapInArrow(_postings(self.n, self.num, self.den, frequent), "token long, salt int, sid long, pos int")
        live = made.repartition("token", "salt").sortWithinPartitions("token", "salt").mapInArrow(_shared, made.schema)
        parity = self.signed.where("low is not null").select("sid", "n", *PARITY).dropDuplicates(["sid"])
        # the shared token before: two sets with the same one are proposed there already
        previous = F.lag("token").over(Window.partitionBy("sid").orderBy("pos", "token"))
        live = stored(live.join(parity, "sid").withColumn("previous", previous), "ngram-postings", release=True)
        frequent.destroy()  # the driver holds its copies until then
        large = stored(live.groupBy("token").count().where(F.col("count") > BUCKET), "ngram-large")
        rare, often = live.join(large, "token", "left_anti"), live.join(large.select("token"), "token")
        near = rare.repartition("token").sortWithinPartitions("token").mapInArrow(_near(self.num, self.den), "u long, v long")
        lead = stored(often.groupBy("token").agg(F.min(F.struct("pos", "n", "sid", *PARITY)).alias("lead")).select("token", "lead.*"), "ngram-leaders")
        x, y = often.alias("x"), lead.alias("y")
        led = self.pairs(x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.sid") != F.col("y.sid")) & self.feasible("x", "y")))
        proposed = stored(self.agree(near.unionByName(led).distinct()), "ngram-pairs")
        first = stored(proposed.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"), "ngram-first")
        links = stored(self.linked(first, classes), "ngram-links", release=True)
        root = components(links)
        of = lambda name: root.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))
        between = proposed.join(of("u"), "u", "left").join(of("v"), "v", "left")
        between = between.where(F.coalesce("root_u", "u") != F.coalesce("root_v", "v")).select("u", "v")
        untried = lambda pairs, name: stored(pairs.distinct().join(tried, ["u", "v"], "left_anti"), name, release=True)
        tried = first
        one = untried(self.agree(self.strays(often, lead, of("sid"), one=True).distinct()).unionByName(between), "ngram-one")
        links = stored(links.unionByName(self.linked(one, classes)), "ngram-links", release=True)
        root, tried = components(links), first.unionByName(one)
        rest = untried(self.agree(self.strays(often, lead, of("sid"), one=False).distinct()), "ngram-rest")
        return links.unionByName(self.linked(rest, classes))

    def strays(self, often: DataFrame, lead: DataFrame, roots: DataFrame, one: bool) -> DataFrame:
        """Pairs that may be linked of a large bucket's members outside its leader's component with all members of other components.

        The members outside (left) and all members (right) are dealt into parts of about ``SIDE``;
        each part of one meets each of the other in a block, whose wide parities are compared as
        matrices. Only pairs that pass leave the block, or ``one`` of them for each member outside.
        """
        rooted = lambda rows: rows.join(roots, "sid", "left").withColumn("root", F.coalesce("root_sid", "sid")).drop("root_sid")
        heads = rooted(lead.select("token", "sid")).select("token", F.col("root").alias("head"))
        marked = stored(rooted(often.select("token", "sid", "pos", "previous")).join(heads, "token"), "ngram-frequent")
        outside = F.col("root") != F.col("head")
        sizes = marked.groupBy("token").agg(F.ceil(F.count_if(outside) / SIDE).cast("int").alias("lefts"), F.ceil(F.count(F.lit(1)) / SIDE).cast("int").alias("rights"))
        marked = marked.join(stored(sizes.where("lefts > 0"), "ngram-blocks"), "token")
        part = lambda seed, n: F.pmod(F.xxhash64("sid", F.lit(seed)), F.col(n)).cast("int")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = marked.where(outside).withColumn("i", part(1, "lefts")).withColumn("j", each("rights")).withColumn("is_left", F.lit(True))
        right = marked.withColumn("j", part(2, "rights")).withColumn("i", each("lefts")).withColumn("is_left", F.lit(False))
        known = self.signed.where("low is not null").select("sid", "n", "wide").dropDuplicates(["sid"])
        rows = left.unionByName(right).join(known, "sid").withColumn("block", F.xxhash64("token", "i", "j"))
        rows = rows.select("block", "token", "sid", "n", "pos", "previous", "root", "head", "is_left", "wide")
        return rows.repartition("block").sortWithinPartitions("block").mapInArrow(_across(self.num, self.den, one), "u long, v long")


def ngram_groups(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) as doc_id, n_shingles, component_id, sid (class, null without n-grams), stays.

    Documents link when den * intersection >= num * union of their n-gram sets; component_id is
    the smallest doc_id reachable by links. Of each component stay the rows of one doc_id and
    class: the smallest doc_id, null last, and of its classes the smallest.
    """
    join = _Join(docs, n, num, den)
    classes = stored(join.signed.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("first_id")), "ngram-classes")
    root = components(join.links(classes))
    linked = classes.join(root.select(F.col("node").alias("sid"), "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    smallest = linked.groupBy("root").agg(
        F.min("first_id").alias("component"), F.min(F.struct(F.col("first_id").isNull().alias("unnamed"), "first_id", "sid")).alias("first")
    )
    of_class = linked.join(smallest, "root").select("sid", "component", "first_id", (F.col("first.sid") == F.col("sid")).alias("leads"))
    rows = join.signed.select("doc_id", "n", "sid").join(of_class, "sid", "left")
    alone = F.col("sid").isNull()
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        "sid", (alone | (F.col("leads") & F.col("doc_id").eqNullSafe(F.col("first_id")))).alias("stays"),
    )


def ngram_components(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id of every document of ``docs`` (doc_id, text)."""
    return ngram_groups(docs, n, num, den).select("doc_id", "n_shingles", "component_id")


def _with_class(n: int, text: int, schema):
    """Rows with the class of their text as one more column."""

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = token_sets([t or "" for t in part.column(text).to_pylist()], n)
                sids = pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, sids], names=wanted.names)

    return run


def without_near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component is kept, with all their columns.

    A doc_id that stands once names its row, so its decision is one on the doc_id. Rows without a
    doc_id, or whose doc_id stands on several rows, are told apart by the class of their text: of
    those with equal doc_id and class one stays, if that class leads its component. Rows without
    n-grams are no copies of anything and all stay.
    """
    found = stored(ngram_groups(docs, n, num, den), "near-groups")
    named = found.where("doc_id is not null")
    repeated = stored(named.groupBy("doc_id").count().where("count > 1").select("doc_id"), "near-repeated")
    # stored, so that Spark knows their size before it plans the joins
    others = stored(named.where("not stays").select("doc_id").join(repeated, "doc_id", "left_anti"), "near-others", release=True)
    kept = docs.where("doc_id is not null").join(others, "doc_id", "left_anti")
    if repeated.isEmpty() and found.where("doc_id is null").isEmpty():
        return kept.select(docs.columns)
    kept = kept.join(repeated, "doc_id", "left_anti").select(docs.columns)
    several = docs.where("doc_id is null").unionByName(docs.join(repeated, "doc_id", "left_semi").select(docs.columns))
    sid = "class_of_text"
    while sid in docs.columns:
        sid += "_"
    schema = T.StructType([*docs.schema.fields, T.StructField(sid, T.LongType())])
    several = several.mapInArrow(_with_class(n, docs.columns.index("text"), schema), schema)
    blank = several.where(F.col(sid).isNull()).select(docs.columns)
    lead = found.where("stays and sid is not null").select(F.col("doc_id").alias("lead_id"), F.col("sid").alias("lead_sid")).distinct()
    several = several.join(lead, F.col("doc_id").eqNullSafe(F.col("lead_id")) & (F.col(sid) == F.col("lead_sid")), "left_semi")
    row = F.struct(*docs.columns)
    one = several.groupBy("doc_id", sid).agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias("row")).select("row.*")
    return kept.unionByName(blank).unionByName(one)

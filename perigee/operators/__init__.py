"""DataFrame-to-DataFrame operators: views, marts, detectors, labels, evaluation, checks."""

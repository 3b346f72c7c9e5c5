"""Operators of a training-data pipeline: PII, BPE, importance resampling, SetSketch near-dedup,
weakly supervised quality rules, source mixing, token-id files, Order MinHash, secret scans,
positive-unlabelled toxicity, n-gram Jaccard join, bit-sliced search and periodic runs.  Nothing outside this folder (but ``corpus_pipeline.py`` and the
guarded import in ``__spark_entry__.py``) imports it."""

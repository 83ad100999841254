"""Corpus preparation operators for training data.

Each module holds one operator with its own general interface; ``registry``
turns them into the ``opN_*`` queries over the test tables. Nothing outside
this package imports it except the entry module (guarded) and
``corpus_pipeline.py``.
"""

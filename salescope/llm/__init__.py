"""Training-data operators as Spark jobs.

Ten operators over ``documents``, ``pages`` and ``benchmark``: main-text
extraction, licence scan, n-gram Jaccard join, benchmark decontamination,
token-id output, URL filter, quality rules, language-model scores, secret
scan and sequence packing. Nothing else in the package imports this one.
"""

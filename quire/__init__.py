"""quire — document assessment and topic conversion as Spark DataFrame operators.

Subpackages: ``functions`` (Column helpers), ``operators`` (sections, features,
scoring, near duplicates, classification, topics), ``plans`` (conversion plans,
stages, report), ``sources`` (files, derived corpora, sinks), ``streaming``.
"""

__version__ = "0.1.0"

"""termloom: terminology and multilingual text analytics on Spark.

The core subpackages hold the operators for lexicon entries, drafts and event
logs.  Training-data operators live in ``termloom.llm``; nothing in the core
imports that subpackage, so it can be left out of an installation.
"""

__version__ = "0.1.0"

"""quarry: corpus analytics on Spark DataFrames.

Cleaning, deduplication, relevance filtering, topic keywords, entity
extraction, dictionary tagging, classifier training and grouped / windowed
reports, written as Spark column expressions, joins, aggregates and windows.
"""

__version__ = "0.1.0"

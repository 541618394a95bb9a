"""reviewlens: review analytics on Spark.

Sentiment models over review text (tokens, stop words, Word2Vec, four tuned
classifiers) and reviewer helpfulness (vote parsing, totals, rates, rankings),
written as DataFrame expressions and Spark ML stages.
"""

__version__ = "0.1.0"

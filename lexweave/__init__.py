"""lexweave: document corpora as trees, spans and property graphs on Spark DataFrames."""

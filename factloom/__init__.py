"""Facts from tagged documents, and the evaluation of extracted values, on Spark."""

"""Training-data operators for corpora of documents, vectors and urls."""

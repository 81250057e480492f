"""Retrieval analytics on Spark: routing, vector search and reranking, citation graphs, report documents, evaluation."""

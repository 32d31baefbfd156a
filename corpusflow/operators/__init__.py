"""Operators over whole tables: chunking, retrieval, fusion, context, cache, usage."""

"""Paged-text analytics on Spark: styled documents to pages, tables, HTML and triples."""

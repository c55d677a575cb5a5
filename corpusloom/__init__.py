"""Corpus preparation as Spark jobs: parse, clean, deduplicate, count, score, sample, report."""

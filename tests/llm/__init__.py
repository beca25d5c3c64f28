"""Tests of cordon.llm and corpus_pipeline."""

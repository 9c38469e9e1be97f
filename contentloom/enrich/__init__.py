"""Enrichment tables: scores, entities, topics, phrases, vectors, summaries, transcripts."""

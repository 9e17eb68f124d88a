"""Store-operations analytics as Spark jobs: land, clean, model, check and report multi-store extracts."""

"""Supply-chain analytics on PySpark: load, check, model, score."""

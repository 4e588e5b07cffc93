"""quern: corpus preparation and retrieval as PySpark DataFrame operators."""

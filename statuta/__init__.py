"""statuta: document-to-graph analytics as Spark DataFrame programs."""

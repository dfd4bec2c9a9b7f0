"""tidemark: analytics over tables and streams, written as PySpark DataFrame programs."""

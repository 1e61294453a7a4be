"""mdcatalog: a metadata catalog over a lake of tables and a corpus of documents, on Spark."""

"""Reading and writing of documents, batch files and artifacts."""

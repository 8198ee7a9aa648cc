"""Column functions: paths, languages, media types, arrays, texts and vectors."""

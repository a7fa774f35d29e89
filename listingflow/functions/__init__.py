"""Column-expression builders (text normalisation), fixed pattern values, portable regex
fragments and the in-task HTML helper."""

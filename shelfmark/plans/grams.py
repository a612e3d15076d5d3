"""SQL of the trigram set of a review text."""

GRAMS_SQL = """list_distinct(flatten(list_transform(
        list_distinct(regexp_extract_all(lower(review), '[\\p{L}\\p{N}]+')),
        lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"""

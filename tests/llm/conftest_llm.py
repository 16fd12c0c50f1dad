"""Names that this folder's tests share."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Words for texts that differ.
WORDS = "house on the hill with garden and view of lake near old town for sale by owner bright warm quiet".split()


def text(seed: int, n: int) -> str:
    """n words, the same for the same seed."""
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 400)) for _ in range(n))


def rows(df):
    """Rows as a sorted list, NULL first."""
    return sorted((tuple(r) for r in df.collect()), key=repr)

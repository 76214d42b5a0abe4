"""Invented words for the tests."""

SYLLABLES = "an be co du el fi go ha in jo ka lu me no or pa qu ri su ti".split()


def words(rng, count, size=3):
    return [f"{''.join(rng.choice(SYLLABLES) for _ in range(size))}" for _ in range(count)]


def prose(rng, count):
    out = words(rng, count)
    for i in range(rng.randrange(4, 11), count, 9):
        out[i] += "."
    return " ".join(out)

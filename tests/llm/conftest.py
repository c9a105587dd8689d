import random

import pytest

SCHEMA = "doc_id long, text string, n_words string, score string, uid string, block string"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def sentence(rng, n, words=400):
    return " ".join("".join(rng.choices(LETTERS[:8], k=1 + rng.randrange(words) % 7)) for _ in range(n))


def odd_texts():
    """Texts with copies, near copies, shared passages, odd blanks and characters, and nothing at all."""
    rng = random.Random(11)
    base = [sentence(rng, rng.randint(15, 90)) for _ in range(12)]
    passage = sentence(rng, 30)
    texts = [None, "", " \t\n ", "one", "One two", "a b c d", "x " * 200, "é ö ß.\x1cend", "word\x0bword\r\nword"]
    texts += base + base[:4]
    for text in base[:6]:
        words = text.split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
        texts.append("\n".join(words[:-1]))
        texts.append(" ".join(words) + " " + passage)
        texts.append("Other start " + passage.upper() + "\n" + passage + "  " + sentence(rng, 20))
    texts.append(" ".join(base) * 4)
    return texts


@pytest.fixture(scope="session")
def odd(spark):
    """Those texts as documents, with ids out of order, null and repeated ids, and columns of clashing names."""
    texts = odd_texts()
    rng = random.Random(3)
    ids = rng.sample(range(-5, 1000), len(texts))
    rows = list(zip(ids, texts, strict=True))
    rows += [(None, texts[12]), (None, texts[12]), (ids[13], texts[13]), (ids[14], texts[15])]
    rng.shuffle(rows)
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

"""Texts and rows for the tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"{a}{b}" for a in "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo zu".split() for b in "lan ner sit mot rus dal fen gor pim tas".split()]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng: random.Random, text: str, share: float) -> str:
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in text.split(" "))


def rows_of(texts, source="s", lang="en"):
    return [(i, t, lang, source, len(t or "")) for i, t in enumerate(texts)]

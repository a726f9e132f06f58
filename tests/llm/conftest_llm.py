"""Texts and plain definitions that the tests share."""

import random
import re

VOCABULARY = "the of and le la der die Éa ñu tion 日本 x1 42 a-b Foo, BAR. \\e </s>".split()


def prose(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(VOCABULARY) + rng.choice([" ", " ", " ", "\n", "  ", "\t"]) for _ in range(n))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")

"""The Viterbi decoder against all readings of short tokens, and on very long ones."""

import itertools
import random
import time

import numpy as np
import pytest

from stallwatch.llm.charlm import SYMBOLS, symbol
from stallwatch.llm.toxicity import _options, restore

rng = np.random.default_rng(9)
LOG_PROBS = np.log(rng.dirichlet(np.full(SYMBOLS, 0.2), (SYMBOLS, SYMBOLS)) + 1e-9)


def readings(token):
    """(score, text) of every way to read a token."""
    token = token.lower()
    for path in itertools.product(*[_options(c, token[i - 1] if i else "") for i, c in enumerate(token)]):
        a = b = 0
        score = 0.0
        for letter, cost in path:
            score += cost
            if letter:
                s = symbol(letter)
                score += LOG_PROBS[a, b, s]
                a, b = b, s
        yield score + LOG_PROBS[a, b, 0], "".join(x for x, _ in path)


@pytest.mark.parametrize("letters", ["ab1|0", "l1i!|", "aaab", "é1ñ3x", "a.-1 b", "1", "x5$s"])
def test_against_all_readings(letters):
    draw = random.Random(letters)
    for _ in range(60):
        token = "".join(draw.choice(letters) for _ in range(draw.randint(1, 10)))
        best = max(readings(token))
        got = restore(token, LOG_PROBS)
        assert got in {text for score, text in readings(token) if score > best[0] - 1e-9}, token


def quadratic(token):
    """Every state carries its whole text."""
    states, before = {(0, 0): (0.0, "")}, ""
    for c in token.lower():
        after = {}
        for (a, b), (score, text) in states.items():
            for letter, cost in _options(c, before):
                key = (b, symbol(letter)) if letter else (a, b)
                total = score + cost + (LOG_PROBS[a, b, symbol(letter)] if letter else 0)
                if key not in after or total > after[key][0]:
                    after[key] = (total, text + letter)
        states, before = after, c
    return max((score + LOG_PROBS[a, b, 0], text) for (a, b), (score, text) in states.items())[1]


@pytest.mark.parametrize("letters", ["abcdefghijklmnop0123456789+/", "1|l", "aab1", "1", "é1!|"])
def test_long_tokens_are_read_as_by_whole_texts(letters):
    draw = random.Random(letters)
    token = "".join(draw.choice(letters) for _ in range(3000))
    assert restore(token, LOG_PROBS) == quadratic(token)


def test_time_is_in_proportion_to_the_length():
    draw = random.Random(1)
    for letters in ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "1"):
        token = "".join(draw.choices(letters, k=5_000_000 if len(letters) > 1 else 500_000))
        begun = time.monotonic()
        restore(token, LOG_PROBS)
        assert time.monotonic() - begun < 60


def test_empty():
    assert restore("", LOG_PROBS) == "" and restore("...", LOG_PROBS) == ""

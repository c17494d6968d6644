"""The mixture inference, recomputed in plain Python from the definition."""

import math
import random

import numpy as np
import pytest

from tierflow.llm.langid import BUCKETS, Languages, trigrams

WORDS = {
    "de": "der die das und nicht ist ein sich mit werden straße größe".split(),
    "en": "the and of that with which from have this would their".split(),
    "es": "el los que una para con esta como pero más también".split(),
    "fr": "les des une dans pour qui sur avec cette où déjà être".split(),
}


def plain_trigrams(text):
    """Buckets of the trigrams of letters, blanks in place of everything else."""
    data = [b if 97 <= b <= 122 or b >= 128 else 32 for b in b" " + text.lower().encode() + b" "]
    return [((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> 18 for a, b, c in zip(data, data[1:], data[2:])
            if not (a == b == 32 or b == c == 32)]


def learned():
    table = np.full((len(WORDS), BUCKETS), 0.5)
    for row, words in enumerate(WORDS.values()):
        for bucket in plain_trigrams(" ".join(words * 5)):
            table[row, bucket] += 1
    return Languages(list(WORDS), table / table.sum(axis=1, keepdims=True))


def mix(chances, rounds=30):
    """EM over single occurrences: the share of each language in each, averaged."""
    weights = [1 / len(chances)] * len(chances)
    for _ in range(rounds):
        totals = [0.0] * len(chances)
        for occurrence in zip(*chances):
            whole = sum(w * p for w, p in zip(weights, occurrence))
            for i, p in enumerate(occurrence):
                totals[i] += weights[i] * p / whole
        after = [t / len(chances[0]) for t in totals]
        moved = max(abs(a - b) for a, b in zip(after, weights))
        weights = after
        if moved < 1e-3:
            break
    return weights, sum(math.log(sum(w * p for w, p in zip(weights, o))) for o in zip(*chances))


def plain_inference(model, text, penalty):
    seen = plain_trigrams(text)
    chances = [[model.chance[i, b] for b in seen] for i in range(len(model.names))]
    single = [sum(map(math.log, c)) for c in chances]
    price = penalty * math.log(1 + len(seen))
    best = max(range(len(single)), key=single.__getitem__)
    reached, found = single[best] - price, {model.names[best]: 1.0}
    everything, _ = mix(chances)
    order = sorted(range(len(chances)), key=lambda i: -everything[i])
    for k in range(2, len(order) + 1):
        weights, likelihood = mix([chances[i] for i in order[:k]])
        if likelihood - k * price > reached:
            reached = likelihood - k * price
            found = {model.names[i]: w for i, w in zip(order, weights)}
    return found


def documents():
    rng = random.Random(6)
    for size in (1, 5, 40, 200):
        for langs in (["de"], ["fr", "en"], ["de", "es"], ["en", "es", "fr"], list(WORDS)):
            yield " ".join(rng.choice(WORDS[rng.choice(langs)]) for _ in range(size))
    yield from ("xq zv wk " * 30, "straße!  größe", "a")


@pytest.mark.parametrize("penalty", [0.5, 4.0])
def test_inference_equals_the_definition(penalty):
    model = learned()
    several = 0
    for text in documents():
        buckets, _ = trigrams([text])
        assert buckets.tolist() == plain_trigrams(text)
        got, _ = model.infer(np.bincount(buckets, minlength=BUCKETS), penalty)
        want = plain_inference(model, text, penalty)
        assert set(got) == set(want)
        assert all(got[n] == pytest.approx(want[n], abs=1e-9) for n in want)
        several += len(want) > 1
    assert several >= 5


def test_proportions_are_those_of_highest_likelihood():
    model = learned()
    text = " ".join(WORDS["de"] * 6 + WORDS["fr"] * 2)
    seen = plain_trigrams(text)
    got, _ = model.infer(np.bincount(seen, minlength=BUCKETS), 0.5)
    assert set(got) == {"de", "fr"}

    def likelihood(share):
        return sum(math.log(share * model.chance[0, b] + (1 - share) * model.chance[3, b]) for b in seen)

    best = max((n / 1000 for n in range(1, 1000)), key=likelihood)
    assert got["de"] == pytest.approx(best, abs=0.01)

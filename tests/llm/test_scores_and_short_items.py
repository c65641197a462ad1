"""Toxicity against a plain scan of every place and short benchmark items."""

import math
import random

import pytest

from riskweave.llm import decontamination, toxicity


def plain_hits(folded, lexicon):
    """Every place against every term and phrase; the heaviest term of a word counts unless a phrase covers its start."""
    same = lambda x: x.replace("l", "i")
    covered = [False] * len(folded)
    for phrase in map(same, lexicon.exceptions):
        for at in range(len(folded)):
            if folded.startswith(phrase, at):
                for place in range(at, at + len(phrase) - 1):
                    covered[place] = True
    found = {}
    for at in range(len(folded)):
        weights = [w for term, w in lexicon.terms.items() if folded.startswith(same(term), at)]
        if weights and not covered[at]:
            found[at] = max(weights)
    return sorted(found.items())


def test_toxicity_against_a_plain_scan():
    draw = random.Random(4)
    words = ["alpha", "alp", "beta", "bet", "gamma", "l1l", "ill", "kill", "time", "killtime", "b3ta", "γamma", "KILL", "..."]
    for _ in range(300):
        lexicon = toxicity.Lexicon(
            {draw.choice([f" {w} ", f" {w}"]): draw.choice([0.5, 1.0, 2.5]) for w in draw.sample(words[:9], 4)},
            tuple({f" {draw.choice(words[:9])} {draw.choice(words[:9])} " for _ in range(draw.randint(0, 3))}))
        folded = toxicity.fold(" ".join(draw.choice(words) for _ in range(draw.randint(0, 25))))
        automaton = lexicon.automaton()
        expected = plain_hits(folded, lexicon)
        assert toxicity.hits(folded, automaton) == expected, (folded, lexicon)
        total = sum(w for _, w in expected)
        n_words = len(folded.split())
        assert toxicity.measure(folded, automaton) == pytest.approx((math.log1p(total), math.log1p(100 * total / (n_words + 20))))


def test_short_items_must_occur_whole(spark):
    items = spark.createDataFrame([(1, "green tea"), (2, "one two three four"), (3, "   "), (4, None), (5, "Solo!")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "some GREEN tea, please"), (2, "green and tea"), (3, "one two three five four"), (4, "so one two, three four go"),
         (5, "a solo"), (6, "solos"), (7, ""), (8, None)], "doc_id long, text string")
    got = decontamination.contaminated(docs, items).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, got)) == [(1, 1), (4, 2)]
    single = decontamination.contaminated(docs, items, min_item_words=1).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, single)) == [(1, 1), (4, 2), (5, 5)]

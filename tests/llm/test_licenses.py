"""Licence notices that are wrapped, commented out or inside other text."""

from __future__ import annotations

import random
import re

from tallyfold.llm import licenses

MIT = licenses.TEMPLATES[2][1]


def _grams(listed):
    return {" ".join(g) for g in zip(listed, listed[1:], strict=False)} if len(listed) > 1 else set(listed)


def _dice(a, b):
    return 2.0 * len(a & b) / (len(a) + len(b))


def _plain(text, threshold=licenses.THRESHOLD):
    """license -> best Dice of the whole text, if it has several lines, and of every window at every word."""
    split, best = re.findall("[a-z0-9]+", text.lower()), {}
    for name, body in licenses.TEMPLATES:
        listed = re.findall("[a-z0-9]+", body.lower())
        parts = [split[i : i + len(listed)] for i in range(len(split))]
        parts += [split] if "\n" in text and split else []
        top = max((_dice(_grams(p), _grams(listed)) for p in parts), default=0.0)
        if top >= threshold:
            best[name] = max(best.get(name, 0.0), top)
    return best


def _wrapped(text, width, mark=""):
    listed = text.split()
    return "\n".join(mark + " ".join(listed[i : i + width]) for i in range(0, len(listed), width))


def test_windows_equal_every_window_of_a_plain_search(spark):
    rng = random.Random(5)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in t.split()})
    code = "\n".join(f"total_{i} = price_{i} * {i}" for i in range(60))
    texts = [
        _wrapped(MIT, 11) + "\n" + code,
        code + "\n" + _wrapped(MIT, 9, "# ") + "\n" + code,
        "The tool is free. Released under the MIT License. Contact us for more.",
        "One part is Licensed under CC BY 4.0. The rest: Licensed under the Apache License, Version 2.0. See there.",
        "Licensed under CC BY 4.0.",
        "no notice at all",
        "license",
        "",
        " ".join(rng.choice(vocabulary) for _ in range(400)),
    ]
    for _ in range(8):
        name, body = rng.choice(licenses.TEMPLATES)
        changed = [w if rng.random() < 0.95 else "word" for w in body.split()]
        texts.append(" ".join(["some", "plain", "text", *changed, "and", "more", "of", "it"]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.scan(df).filter("line = 0").collect()
    got = {(r["doc_id"], r["license"]): round(r["dice"], 12) for r in rows}
    want = {(i, name): round(v, 12) for i, t in enumerate(texts) for name, v in _plain(t).items()}
    assert got == want
    assert got[0, "MIT"] > 0.95 and got[1, "MIT"] > 0.8 and got[2, "MIT"] == 1.0
    assert got[3, "CC-BY-4.0"] == 1.0 and (3, "Apache-2.0") in got


def test_a_notice_repeated_in_a_long_text_ends(spark):
    text = "\n".join([_wrapped(MIT, 11)] * 100)
    df = spark.createDataFrame([(1, text), (1, text), (None, None)], "doc_id long, text string")
    rows = licenses.scan(df).filter("line = 0").collect()
    assert [(r["doc_id"], r["license"], r["dice"]) for r in rows] == [(1, "MIT", 1.0)]

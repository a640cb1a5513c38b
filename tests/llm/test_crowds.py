from __future__ import annotations

import random

import numpy as np
import pytest
from llm.conftest import rows_by_id
from llm.test_near_copies import brute

from stayrate.llm import near_copies as module


def family(n, seed=7):
    """Texts with two changes each, too many to be linked; of every fourth also one with a further change, which is linked to it."""
    draw = random.Random(seed)
    base, rows = [f"w{i}" for i in range(60)], []
    for _ in range(n):
        text = list(base)
        for k in draw.sample(range(6, 54), 2):
            text[k] = f"x{draw.randrange(10**6)}"
        rows.append(text)
        if draw.randrange(4) == 0:
            again = list(text)
            again[draw.choice([5, 30, 55])] = f"y{draw.randrange(10**6)}"
            rows.append(again)
    draw.shuffle(rows)
    return [(k, " ".join(text)) for k, text in enumerate(rows)]


def counted(monkeypatch):
    """Rows dealt to blocks, and what they come from: visits and members of groups."""
    seen = {}
    block_rows, written = module.block_rows, module.written

    def blocks(visits, parts):
        out = written(block_rows(visits, parts), "rows")
        seen["rows"] = out.count()
        return out

    def kept(df, name):
        out = written(df, name)
        if name in ("visits", "parts"):
            seen.setdefault(name, out.count())
        return out

    monkeypatch.setattr(module, "block_rows", blocks)
    monkeypatch.setattr(module, "written", kept)
    return seen


def test_rows_dealt_to_blocks_do_not_grow_with_the_square_of_a_family(documents_of, monkeypatch):
    monkeypatch.setattr(module, "HOSTS", 16)
    monkeypatch.setattr(module, "GUESTS", 32)
    rows, seen = family(200), counted(monkeypatch)
    out = rows_by_id(module.near_copies(documents_of(rows)))
    want = brute(rows, 5)
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in out.items()} == want
    assert len({c for _, c in want.values()}) < len(rows) - 20
    assert seen["visits"] > 1000 and seen["rows"] <= seen["visits"] + seen["parts"]


@pytest.mark.parametrize("limits", [{"SIDE": 3, "PAIRS": 1, "TURNS": 1}, {"SIDE": 8, "PAIRS": 0, "TURNS": 2}, {"CELLS": 8}])
def test_what_the_turns_leave_is_compared_in_blocks(documents_of, monkeypatch, limits):
    for name, value in {"HOSTS": 8, "GUESTS": 16, **limits}.items():
        monkeypatch.setattr(module, name, value)
    rows = family(60, 9)
    out = rows_by_id(module.near_copies(documents_of(rows)))
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in out.items()} == brute(rows, 5)


def test_no_row_with_a_partner_is_passed_over():
    draw = np.random.default_rng(2)
    for _ in range(200):
        n = draw.integers(2, 40)
        part, size = draw.integers(0, 4, n), draw.integers(5, 30, n)
        rest = size - draw.integers(0, 5, n)
        common = module._common(size[:, None], size, 80)
        fits = (np.minimum(rest[:, None], rest) >= common) & (part[:, None] != part)
        assert (module._may_have_partners(part, size, rest, 80) == fits.any(axis=1)).all()

import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from chronotape.llm import spelling
from chronotape.llm.spelling import count_runs, near_in_tiles, spelling_variants
from tests.llm.conftest import WORDS, sentence

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vocabulary(rows, least_count=3):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= least_count}


def edits_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(rows, least_count=3):
    words = vocabulary(rows, least_count)
    near = {w: sorted((x for x in words if edits_apart(w, x)), key=lambda x: (-words[x], x)) for w in words}
    form = {w: (near[w][0] if near[w] and words[near[w][0]] >= 2 * n else None) for w, n in words.items()}
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], words[form[w]] if form[w] else None, root))
    return sorted(out)


def run(frame, **given):
    columns = ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(map(tuple, spelling_variants(frame, **given).select(*columns).collect()))


def variants(seed, count):
    """Words that are edits of each other, some beyond ASCII, with counts that make chains of forms."""
    random = np.random.default_rng(seed)
    letters = list("abcdeé\u00f7\u00c0")
    words = ["".join(random.choice(letters, random.integers(4, 9))) for _ in range(12)]
    for _ in range(count):
        w = words[random.integers(len(words))]
        p, c = random.integers(len(w)), random.choice(letters)
        words.append([w[:p] + w[p + 1 :], w[:p] + c + w[p:], w[:p] + c + w[p + 1 :]][random.integers(3)] or "abcde")
    return words


def test_equals_brute_force(spark, clashing, monkeypatch):
    rows = [(k, " ".join(variants(k % 4, 150) * (1 + k % 3))) for k in range(16)]
    rows += [(100, None), (101, ""), (None, "amber Amber AMBER amberx"), (102, "12 - ;"), (103, "ÀMBER àmber \u0100mber am\u4e2dber")]
    rows += [(7, sentence(3, 200))] * 3 + [(k, sentence(k, 60) + " Cedarr cedrr") for k in range(200, 230)]
    rows += [(300, "plannett " * 3), (301, "plannet " * 8), (302, "planet " * 20)]  # a chain of forms
    want = brute(rows)
    assert any(r[3] for r in want) and any(r[5] != r[3] and r[3] for r in want)  # forms, and chains of them
    assert run(clashing(rows)) == want
    # a lane of many blocks, few pairs at once
    monkeypatch.setattr(spelling, "BLOCK", 7)
    monkeypatch.setattr(spelling, "STEP", 20)
    monkeypatch.setattr(spelling, "TOGETHER", 50)
    assert run(clashing(rows).repartition(5)) == want


def test_one_lane_holds_most_words(spark, make_documents, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 16)
    text = " ".join(f"internation{a}{b}" for a in "abcdefghij" for b in "abcdefghijkl")
    rows = [(k, text) for k in range(5)]
    assert run(make_documents(rows)) == brute(rows)


def test_no_words(spark, make_documents):
    assert run(make_documents([])) == [] == run(make_documents([(1, None), (2, "a bc def"), (3, "three words only")]))


def test_long_words_and_long_texts_in_pieces(spark, make_documents, monkeypatch):
    monkeypatch.setattr(spelling, "TEXT_BYTES", 50)
    rows = [(k, "x" * 70 + " " + "y" * 300 + " " + sentence(k, 400) + " " + "é" * 66 + " " + "é" * 65) for k in range(6)]
    assert run(make_documents(rows)) == brute(rows)


def test_checksum_of_a_document_and_a_word():
    words = WORDS + ["é" * 5, "é" * 32, "é" * 33, "z" * 64, "z" * 65]
    for doc_id in range(40):
        start = zlib.crc32(f"{doc_id}:".encode())
        text = " ".join(words)
        found, n = count_runs([start], [text.encode("latin-1")], 5)
        got = Counter()
        for w, c in zip(found, n, strict=True):
            got[w.decode("latin-1")] += c
        assert got == Counter(vocabulary([(doc_id, text)], 1))


def test_pairs_are_found_once():
    import pandas as pd

    rows = [(w, 3, side, 5, half, 0, 0, 0) for w in ("abcde", "abcdf", "abcdef") for side, half in (("prefix", "ab"), ("suffix", w[-2:]))]
    rows += [("xbcde", 3, "suffix", 5, "de", 0, 0, 0)]
    frame = pd.DataFrame(rows, columns=["word", "n", "side", "m", "half", "block", "i", "j"])
    links = Counter(map(tuple, near_in_tiles(frame)[["word", "near"]].to_numpy().tolist()))
    want = defaultdict(int)
    for a, b in (("abcde", "abcdf"), ("abcde", "abcdef"), ("abcdf", "abcdef"), ("abcde", "xbcde")):
        if edits_apart(a, b):
            want[(a, b)] = want[(b, a)] = 1
    assert links == Counter(want)

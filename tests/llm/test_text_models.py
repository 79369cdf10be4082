"""Language ID, quality and license scans: held-out accuracy, brute force, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from tierline.llm import language_id, license_scan, quality

SF = "/root/testdata/sf0.01"


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_held_out(docs):
    got = language_id.train_and_identify(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    true = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = got.collect()
    assert len(rows) == len(true)
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == true[r.doc_id] for r in rows if r.held_out]
    assert np.mean(held) > 0.95


def test_a_rare_language_is_learned_beside_a_large_one(spark):
    common = [(i, " ".join(f"aw{i}x{j}" .translate(str.maketrans("0123456789", "bcdfghjklm")) for j in range(40)), "big") for i in range(400)]
    rare = [(1000 + i, f"zup{c} qir{c} vol{c}", "small") for i, c in enumerate("abcde")]
    df = spark.createDataFrame(common + rare, "doc_id long, text string, lang string")
    model = language_id.fit(df, sample_docs=100, max_words=600)
    assert model.languages == ["big", "small"] and all(w in model.words for w in ("zupa", "vole"))
    assert language_id.Scorer(model).score(["zupa qirb volc", "zupx qirx"])[0][0] == "small"
    assert sum(len(w) > 0 for w in model.words) <= 600


def test_shares():
    assert language_id.shares({"a": 5, "b": 100, "c": 1000}, 205) == {"a": 5, "b": 100, "c": 100}
    assert language_id.shares({"a": 5, "b": 7}, 100) == {"a": 5, "b": 7}
    assert language_id.shares({}, 100) == {}


def test_scores_are_a_plain_sum(docs):
    """Against the definition, word by word, with a small memory of chunks."""
    model = language_id.fit(docs, sample_docs=150, max_words=2000)
    scorer = language_id.Scorer(model, limit=500)
    texts = [r.text or "" for r in docs.collect()][:60] + ["", "12 34", "it's Über-groß, x1y"]
    for text, (lang, score) in zip(texts, scorer.score(texts), strict=True):
        words = language_id.LETTERS.findall(text.lower())
        if not words:
            assert (lang, score) == ("und", 0.0)
            continue
        total, chance = [0.0] * len(model.languages), [0.0] * len(model.languages)
        for w in words:
            logs = model.logs[model.words[w]] if w in model.words else None
            if logs is None:
                grams = next((g for n in range(model.longest, 0, -1) if (g := [model.logs[model.grams[x]] for i in range(len(w) + 3 - n) if (x := f"^{w}$"[i : i + n]) in model.grams])), None)
                logs = [sum(g[k] for g in grams) / len(grams) for k in range(len(total))] if grams else [0.0] * len(total)
            e = [np.exp(x - max(logs)) for x in logs]
            for k in range(len(total)):
                total[k] += logs[k]
                chance[k] += e[k] / sum(e)
        best = max(range(len(total)), key=lambda k: (round(total[k], 9), -k))
        assert lang == model.languages[best] and score == pytest.approx(chance[best] / len(words))


def test_language_by_hand():
    model = language_id.from_counts([("xx", "foo", 10), ("xx", "bar", 5), ("yy", "qux", 10), ("yy", "foo", 1)])
    (a, s), (b, _), (c, z), (d, _) = language_id.Scorer(model).score(["Foo foo 12", "quxx", "12 !", "fooz barz"])
    assert (a, b, c, z, d) == ("xx", "yy", "und", 0.0, "xx")
    assert 0.5 < s <= 1
    assert model.rows(["quxqux"])[0].tolist() == pytest.approx(np.mean([model.logs[model.grams[g]] for g in ("^qux", "qux$")], axis=0))


def test_language_odd_rows(odd_docs, no_docs, spark):
    model = language_id.from_counts([("en", "word", 3), ("fr", "mot", 3)])
    rows = language_id.identify(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert {r.lang_pred for r in rows if not any(map(str.isalpha, r.text or ""))} == {"und"}
    assert all(r.lang_pred == "en" for r in rows if (r.text or "").startswith("word"))
    assert language_id.train_and_identify(no_docs).count() == 0
    unlabelled = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in language_id.train_and_identify(unlabelled).collect()] == [(1, False, "und", 0.0)]


def test_quality_held_out(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.train_and_score(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and r.predicted == int(r.score >= 0.5) for r in rows)
    true = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.score, true[r.doc_id]) for r in rows if r.held_out and r.doc_id in true]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.9


def test_words_of_one_look_have_the_same_features():
    words = "reed*** shin*** Thing. THE!! the the, a A Éa éa, über! x|y x1 foo-bar (foo) aaa aab | || *** Aé".split()
    seen = {}
    for w in words + [w[::-1] for w in words]:
        key = quality.look(w)
        assert (seen.setdefault(key, quality.word_features(w)) == quality.word_features(w)).all(), w


def test_quality_gradient():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(k, quality.WIDTH)) for k in (1, 3, 2)]
    x, doc = quality.joined(bags)
    y = np.array([1.0, 0.0, 1.0])
    shapes = {"encode": (quality.WIDTH, 4), "encode0": (4,), "attend": (4, 3), "attend0": (3,), "gate": (4, 3), "gate0": (3,), "weight": (3,), "class": (4,), "class0": ()}
    p = {k: np.asarray(rng.normal(size=s)) for k, s in shapes.items()}

    def loss():
        z = quality.forward(p, x, doc, 3)[0]
        return np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y))

    g = quality.gradient(p, x, doc, y)
    for k in p:
        at = tuple(0 for _ in p[k].shape)
        was = p[k][at].copy()
        p[k][at] = was + 1e-6
        up = loss()
        p[k][at] = was - 1e-6
        down = loss()
        p[k][at] = was
        assert abs((up - down) / 2e-6 - g[k][at]) < 1e-6


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (9, 0, None), (4, 1, 0), (5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.train_and_score(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    nothing = labels.where("false")
    assert {r.score for r in quality.train_and_score(odd_docs, nothing).collect()} == {0.5}
    assert quality.train_and_score(no_docs, labels).count() == 0


def test_patience_alignment():
    a, b = "x a b q c d y".split(), "a b c d".split()
    assert license_scan.align(a, b) == [(1, 0), (2, 1), (4, 2), (5, 3)]
    assert license_scan.align("a a a".split(), "a".split()) == [(0, 0)]
    assert license_scan.align([], ["a"]) == []
    assert license_scan.increasing([3, 1, 2, 5, 4]) in ([1, 2, 4], [1, 2, 3])


@pytest.mark.parametrize(("text", "want"), [
    ("Foo. Released under the MIT License.", ["MIT"]),
    ("the the under\nReleased under the MIT License. Bar the license. Released under the MIT license!", ["MIT", "MIT"]),
    ("LICENSED UNDER THE APACHE LICENSE, VERSION 2.0 x Licensed under CC BY-NC 4.0.", ["Apache-2.0", "CC-BY-NC-4.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("This work is licensed by the Public, version 3 of GNU under", []),
    (license_scan.TEMPLATES["MIT-text"].replace("person", "body") + " more", ["MIT-text"]),
    (license_scan.TEMPLATES["Apache-2.0-header"], ["Apache-2.0-header"]),
    ("license " * 1000, []),
])
def test_license_hits(text, want):
    templates = {k: license_scan.WORD.findall(v.lower()) for k, v in license_scan.TEMPLATES.items()}
    assert [h[0] for h in license_scan.scan(license_scan.WORD.findall(text.lower()), templates)] == want


def test_license_copies_with_different_edits():
    one, two = "a b c d e f g X i j".split(), "a Y c d e f g h i j".split()
    template = {"t": "a b c d e f g h i j".split()}
    alone = license_scan.scan(one, template)
    assert [h[1] for h in alone] == [0.9]
    for between in ([], ["z"] * 5, ["z"] * 40, ["z"] * 300):
        for before in ([], ["z"] * 90):
            hits = license_scan.scan([*before, *one, *between, *two, *before], template)
            at = len(before)
            assert hits == [("t", 0.9, at, at + 10), ("t", 0.9, at + 10 + len(between), at + 20 + len(between))], (len(between), at)
    many = (one + ["z"] * 30 + two + ["q"] * 12) * 5
    assert len(license_scan.scan(many, template)) == 10


def test_license_notices_with_different_edits():
    templates = {k: license_scan.WORD.findall(v.lower()) for k, v in license_scan.TEMPLATES.items()}
    rng = np.random.default_rng(3)
    for name in (k for k, v in templates.items() if len(v) > 20):
        text, n = [], len(templates[name])
        for i in range(4):  # one word in ten is another
            copy = list(templates[name])
            for j in rng.choice(n, n // 10, replace=False):
                copy[j] = f"edit{i}x{j}"
            text += [*copy, *[f"w{i}x{j}" for j in range(rng.integers(0, 60))]]
        assert len(license_scan.scan(text, {name: templates[name]})) == 4, name  # alone: the edited word may be what tells two notices apart
        assert len(license_scan.scan(text, templates)) == 4, name


def test_license_table(spark, docs):
    """Every planted notice line is found, and nothing without one."""
    rows = license_scan.scan_licenses(docs).collect()
    lines = {license_scan.TEMPLATES[k]: k for k in ("MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0")}
    for r in rows:
        planted = sorted(lines[x.strip()] for x in r.text.split("\n") if x.strip() in lines)
        assert sorted(h.license for h in r.licenses) == planted
        for h in r.licenses:
            assert h.coverage == 1 and r.text[h.start : h.end] in license_scan.TEMPLATES[h.license]


def test_license_odd_rows(odd_docs, no_docs):
    rows = license_scan.summary(odd_docs).collect()
    assert len(rows) == odd_docs.count() and {r.n_hits for r in rows} == {0}
    assert license_scan.summary(no_docs).count() == 0

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from blotter.llm import quality
from tests.conftest import SF_MEDIUM, SF_SMALL


def brute(text):
    words = re.findall(r"[^ \t-\r]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^ \t-\r]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
    return (
        len(words), len("".join(words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines),
        len(lines) - len(set(lines)), len(covered),
    )


def test_measures_equal_brute_force():
    r = random.Random(3)
    texts = [None, "", " ", "\n\n", "a", "é\u00a0b c\x1cd", "a b\na b\n \na b", "# * <x>"]
    texts += [" ".join(r.choices("ab", k=r.randint(5, 60))) for _ in range(60)]
    texts += ["\n".join(r.choices(["x y z", "p q", "", "  "], k=20)) for _ in range(20)]
    for t in texts:
        assert quality.measure(t) == brute(t), t


def test_repeats_survive_colliding_keys(monkeypatch):
    import numpy as np

    monkeypatch.setattr(quality, "_MULTIPLIERS", np.zeros(8, np.uint64))
    words = "a b c d e f g h i j a b c d e f g h z".split()
    assert quality.repeated_words(words) == 16


def test_upper_bound_is_exact():
    assert abs(quality.upper_bound(0, 100, 0.05) - (1 - 0.05 ** (1 / 100))) < 1e-9
    p = quality.upper_bound(3, 200, 0.01)
    from math import comb

    assert abs(sum(comb(200, i) * p**i * (1 - p) ** (200 - i) for i in range(4)) - 0.01) < 1e-9
    assert quality.upper_bound(5, 5, 0.1) == quality.upper_bound(0, 0, 0.1) == 1.0


def corpus(spark, n=3000):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        bad = r.random() < 0.2
        words = [r.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(r.randint(0, 999)) for _ in range(40)]
        if bad:
            words = [w + r.choice(["###", "***"]) for w in words]
        elif r.random() < 0.3:
            words[0] += "#"
        rows.append((i, " ".join(words), r.choice(["en", "fr", None]) if i else "rare", "s"))
        labels.append((i, 0 if bad else 1, 0))
    return (
        spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string"),
        spark.createDataFrame(labels + [(10**6, 1, 0)], "doc_id long, quality int, toxic int"),
    )


def test_bad_go_good_stay_and_unlabelled_strata_are_left_alone(spark):
    docs, labels = corpus(spark)
    out = quality.quality_rules(docs, labels, alpha=0.1).join(labels, "doc_id")
    n = {(r["quality"], r["kept"]): r["n"] for r in out.filter("lang IS NULL OR lang <> 'rare'").groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert n.get((0, True), 0) == 0 and n.get((1, False), 0) <= 0.1 * n[(1, True)]
    assert quality.quality_rules(docs, labels.limit(0)).filter("NOT kept").count() == 0


def test_keep_good_equals_the_query_and_keeps_columns(spark):
    docs, labels = corpus(spark, 1500)
    kept = {r["doc_id"] for r in quality.quality_rules(docs, labels, alpha=0.1).filter("kept").collect()}
    out = quality.keep_good(docs, labels, alpha=0.1)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(kept)


def test_generated_table_and_odd_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    for r in quality.quality_rules(docs, labels).join(docs.select("doc_id", "text"), "doc_id").limit(60).collect():
        assert tuple(r[c] for c in quality.MEASURES.names) == brute(r["text"])
    odd = spark.createDataFrame([(None, None, None), (1, "", "en"), (1, "", "en")], "doc_id long, text string, lang string")
    out = quality.quality_rules(odd, labels).collect()
    assert len(out) == 3 and all(r["base_failed"] and not r["kept"] for r in out)
    assert quality.quality_rules(docs.limit(0), labels).count() == 0


def test_production_risk_removes_bad_documents_and_bounds_the_joint_loss(spark):
    docs, labels = corpus(spark)
    out = quality.quality_rules(docs, labels).join(labels, "doc_id").filter("lang IS NULL OR lang <> 'rare'")
    n = {tuple(r)[:3]: r["n"] for r in out.groupBy("lang", "quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert {k[0] for k in n} == {"en", "fr", None}
    for lang in ("en", "fr", None):
        assert n.get((lang, 0, True), 0) == 0 < n[lang, 0, False]
        assert n.get((lang, 1, False), 0) <= 0.02 * n[lang, 1, True]


def test_most_rejected_is_where_the_exact_bound_passes_alpha():
    for n, alpha, error in ((0, 0.02, 0.01), (200, 0.02, 0.0025), (297, 0.02, 0.0025), (2000, 0.02, 0.0025), (500, 0.3, 0.01)):
        k = quality.most_rejected(n, alpha, error)
        assert k == -1 or quality.upper_bound(k, n, error) <= alpha
        assert quality.upper_bound(k + 1, n, error) > alpha
    assert quality.labels_needed(0.02, 0.05 / 20) == 297
    assert quality.most_rejected(296, 0.02, 0.05 / 20) == -1 and quality.most_rejected(297, 0.02, 0.05 / 20) == 0


def test_paths_grow_and_catch_every_bad_document_that_a_rule_can():
    import numpy as np

    r = random.Random(9)
    for _ in range(30):
        levels = np.array([[r.choice([0, 0, r.randint(0, s)]) for s in (3, 4, 2)] for _ in range(40)])
        bad = np.array([r.randint(0, 3) for _ in levels])
        for lead in range(3):
            if bad[levels[:, lead] > 0].any():
                told = quality.path(levels, bad, [3, 4, 2], lead)
                assert told[0][lead] < (3, 4, 2)[lead] and len(set(told)) == len(told)
                assert all(a >= b for x, y in zip(told, told[1:]) for a, b in zip(x, y))
                assert quality.rejected(levels, bad, told[-1]) == bad[(levels > 0).any(axis=1)].sum()


def test_rules_that_only_fail_together_are_not_used_together(spark):
    """Each of two rules rejects 2 % of the good documents, other ones each: proven alone, not jointly."""
    rows, labels = [], []
    for i in range(4000):
        bad, kind = i % 4 == 0, i % 3
        m = [100, 600, 0, 10, 0, 0]
        if (bad and kind == 0) or (not bad and i % 200 in (1, 2, 3)):
            m[2] = 400
        if (bad and kind == 1) or (not bad and i % 200 in (5, 6, 7)):
            m[4] = 9
        rows.append((i, "en", *m))
        labels.append((i, 0 if bad else 1, 0))
    measured = spark.createDataFrame(rows, "doc_id long, lang string, " + ", ".join(f"{n} long" for n in quality.MEASURES.names))
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert set(quality.select_cutoffs(measured, known, "lang", alpha=0.035)["en"]) in ({"symbols"}, {"dup_lines"})
    assert set(quality.select_cutoffs(measured, known, "lang", alpha=0.06)["en"]) == {"symbols", "dup_lines"}


def test_keep_good_leaves_columns_of_any_name(spark):
    good = " ".join(f"word{i}" for i in range(40))
    df = spark.createDataFrame([(1, "en", good, 5, "m", "r"), (2, "en", "short", 6, "m", "r"), (3, None, good, None, None, None)],
                               "doc_id long, lang string, text string, __m int, m string, row string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality.keep_good(df, labels)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [(1, "en", good, 5, "m", "r"), (3, None, good, None, None, None)]


def proven(k, n, alpha, error):
    """k of n at probability alpha have a lower tail of at most ``error``, in whole numbers."""
    from fractions import Fraction
    from math import comb

    p = Fraction(alpha).limit_denominator(10**6)
    return k < n and sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) <= Fraction(error)


def brute_kept(rows, labels, alpha, delta=0.05):
    """kept of every row (doc_id, text, lang), document by document, by the operator's definition."""
    rules, sizes = quality.RULES, [len(r.cutoffs) for r in quality.RULES]
    told = {}
    for doc_id, good, toxic in labels:
        told.setdefault(doc_id, []).append((good, toxic))
    measured = [(i, lang, dict(zip(quality.MEASURES.names, brute(text)))) for i, text, lang in rows]
    fails = lambda m: m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]

    def caught(m, r, at):
        if at >= sizes[r] or not m[rules[r].denominator]:
            return False
        value = m[rules[r].numerator] / m[rules[r].denominator]
        return value > rules[r].cutoffs[at] if rules[r].above else value < rules[r].cutoffs[at]

    gone = lambda m, setting: any(caught(m, r, at) for r, at in enumerate(setting))
    strata, paths = {}, {}
    for i, lang, m in measured:
        if i in told and not fails(m):
            good, bad = strata.setdefault(lang, ([], []))
            if all(g == 1 for g, _ in told[i]) and all(t == 0 for _, t in told[i]):
                good.append(m)
            elif any(g == 0 for g, _ in told[i]):
                bad.append(m)
    for lang, (good, bad) in strata.items():
        paths[lang] = []
        for lead in range(len(rules)):
            reach = sum(caught(m, lead, 0) for m in bad)
            if not reach or not good:
                continue
            at, settings = list(sizes), []
            while True:
                left = [m for m in bad if not gone(m, at)]
                # each rule's next cutoff that catches more: the loosest that catches any of those left
                step = [max((k for k in range(sizes[r]) if any(caught(m, r, k) for m in left)), default=None) for r in range(len(rules))]
                gains = [0 if k is None else sum(caught(m, r, k) for m in left) for r, k in enumerate(step)]
                if not any(gains):
                    break
                led = gains[lead] and sum(caught(m, lead, at[lead]) for m in bad) < quality.LEAD * reach
                r = lead if led else gains.index(max(gains))
                at[r] = step[r]
                settings.append(tuple(at))
            paths[lang].append(settings)
    n_strata = sum(bool(p) for p in paths.values())
    chosen = {}
    for lang, (good, bad) in strata.items():
        best = (0, 0, tuple(sizes))
        for settings in paths[lang]:
            for setting in settings:
                k = sum(gone(m, setting) for m in good)
                if not proven(k, len(good), alpha, delta / max(1, n_strata * len(paths[lang]))):
                    break
                best = max(best, (sum(gone(m, setting) for m in bad), -k, setting), key=lambda x: x[:2])
        chosen[lang] = best[2]
    return sorted((i, not fails(m) and not gone(m, chosen.get(lang, tuple(sizes)))) for i, lang, m in measured)


@pytest.mark.parametrize("alpha", [0.02, 0.1, 0.3])
def test_choice_of_cutoffs_equals_brute_force(spark, alpha):
    docs, labels = corpus(spark, 1500)
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    want = brute_kept(rows, list(map(tuple, labels.collect())), alpha)
    assert sorted((r["doc_id"], r["kept"]) for r in quality.quality_rules(docs, labels, alpha=alpha).collect()) == want


def test_choice_of_cutoffs_on_a_generated_table(spark):
    docs, labels = (spark.read.parquet(f"{SF_MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    known = list(map(tuple, labels.select("doc_id", "quality", "toxic").collect()))
    for alpha in (0.02, 0.2):
        want = brute_kept(rows, known, alpha)
        assert sorted((r["doc_id"], r["kept"]) for r in quality.quality_rules(docs, labels, alpha=alpha).collect()) == want
    assert sum(not k for _, k in want) > sum(not k for _, k in brute_kept(rows, known, 0.02))

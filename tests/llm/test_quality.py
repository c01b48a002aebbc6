"""Base columns against a plain version; sketches against exact quantiles; verdicts on planted rows."""

import random
import re
from collections import Counter

import numpy as np

from cofi.llm import quality


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    w8 = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, cover = Counter(w8), set()
    for i, w in enumerate(w8):
        if often[w] > 1:
            cover |= set(range(i, i + 8))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(cover),
            len(words) < 20 or 100 * len(cover) > 30 * len(words))


def texts():
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcéß") for _ in range(r.randint(1, 3)))
    out = [" ".join(word() for _ in range(r.randint(0, 80))) for _ in range(60)]
    line = " ".join(word() for _ in range(9))
    out += [None, "", " \n\t\x0b", "a b c d e f g h " * 4, f"{line}\n{line}\n \n{line} x", "É É " * 30,
            "x y " * 50_000, "# * $ | < >", "\x1cq \x85r"]
    return out


def test_base_columns(spark):
    t = texts()
    df = spark.createDataFrame([(i, x, None, "s", 7) for i, x in enumerate(t)],
                               "doc_id BIGINT, text STRING, lang STRING, source STRING, kept INT")
    rows = quality.judge(df).collect()
    assert len(rows) == len(t)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(t[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_sketches_merge_to_the_quantiles(spark):
    r = np.random.default_rng(3)
    values = np.concatenate([r.lognormal(0, 2, 4000), np.zeros(300)])
    rows = [("en", f"s{i % 7}", 1000, int(v * 1000), 0, 0, 0, 1, 0) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "lang STRING, source STRING, n_words BIGINT, word_chars BIGINT, n_symbols BIGINT, "
                                     "n_dup_lines BIGINT, n_repeat_words BIGINT, n_lines BIGINT, n_upper BIGINT")
    got = quality.quantiles(quality.sketch(df), ["lang"], (0.25, 0.5, 0.9)).where("measure = 'word_length'").first()
    exact = np.quantile(np.floor(values * 1000) / 1000, (0.25, 0.5, 0.9), method="inverted_cdf")
    assert np.allclose([got.q0, got.q1, got.q2], exact, rtol=2 * quality.ALPHA)


def test_outliers_go_clean_stay(spark):
    r = random.Random(8)
    clean = [" ".join("".join(r.choice("etaoinshr") for _ in range(r.randint(2, 8))) for _ in range(r.randint(60, 200)))
             for _ in range(300)]
    junk = [x.upper().replace(" ", "!! ") for x in clean[:5]] + [x.replace(" ", "### ") for x in clean[5:10]]
    df = spark.createDataFrame([(i, x, ("en", None)[i % 2], f"s{i % 3}") for i, x in enumerate(clean + junk)],
                               "doc_id BIGINT, text STRING, lang STRING, source STRING")
    bad = {x.doc_id for x in quality.judge(df).where("NOT kept").collect()}
    assert bad == set(range(300, 310))
    assert quality.keep_good(df).count() == 300
    assert quality.keep_good(df).columns == df.columns
    assert quality.judge(df.limit(0)).count() == 0


def plain_fences(groups, everything):
    """{(lang, source): {measure: (low, high)}} from exact quantiles of plain lists of values; ``groups``:
    {(lang, source): {measure: values}}."""
    at = lambda v: np.quantile(v, quality.QUARTILES, method="inverted_cdf")
    lean = lambda n, own, parent: (n * own + quality.WEIGHT * parent) / (n + quality.WEIGHT)
    out = {}
    for (lang, source), of in groups.items():
        q = {}
        for m in of:
            same = np.concatenate([g[m] for k, g in groups.items() if k[0] == lang])
            q[m] = lean(len(of[m]), at(of[m]), lean(len(same), at(same), at(everything[m])))
        out[lang, source] = {m: (q[m][0] - quality.FENCE * w, q[m][2] + quality.FENCE * w)
                             for m, (size, units, _) in quality.MEASURES.items()
                             for w in [max(q[m][2] - q[m][0], units / max(q[size][1], 1))]}
    return out


def test_verdicts_against_exact_quantiles(spark):
    """Groups of 3 to 400 documents, a null language and a null source: the verdicts of exact quantiles, but
    for values within the sketch's error of a fence."""
    r = random.Random(11)
    rows = []
    for lang, source, n, size in (("en", "a", 400, 5), ("en", "b", 120, 9), ("en", None, 3, 5), (None, "a", 60, 4), ("fr", "c", 8, 7)):
        for _ in range(n):
            words = ["".join(r.choice("etaoin") for _ in range(max(1, int(r.gauss(size, 2))))) for _ in range(r.randint(15, 90))]
            words = [w.upper() if r.random() < 0.02 else w for w in words]
            words += ["#"] * r.choice([0] * 20 + [1, 3, 30]) + words[:9] * r.choice([0] * 15 + [1])
            rows.append((len(rows), " ".join(words), lang, source))
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING")
    got = quality.judge(df).collect()
    values = lambda x: {"word_length": x.word_chars / x.n_words, "symbol_share": x.n_symbols / x.n_words,
                        "repeat_share": x.n_repeat_words / x.n_words, "upper_share": x.n_upper / x.word_chars,
                        "n_words": x.n_words, "word_chars": x.word_chars}
    groups, everything = {}, {}
    for x in got:
        for m, v in values(x).items():
            groups.setdefault((x.lang, x.source), {}).setdefault(m, []).append(v)
            everything.setdefault(m, []).append(v)
    fences, rejected = plain_fences(groups, everything), 0
    for x in got:
        sure, inside, v = True, True, values(x)
        for m, (_, _, low_too) in quality.MEASURES.items():
            low, high = fences[x.lang, x.source][m]
            room = 0.1 * (high - low)
            inside &= v[m] <= high and (not low_too or v[m] >= low)
            sure &= abs(v[m] - high) > room and (not low_too or abs(v[m] - low) > room)
        assert not sure or x.kept == (inside and not x.base_failed)
        rejected += sure and not inside and not x.base_failed
    assert rejected > 5


def test_fences_follow_the_group(spark):
    """The same texts, copies of one row among them, are usual in one source and outliers in the other."""
    r = random.Random(5)
    text = lambda size: " ".join("".join(r.choice("etaoin") for _ in range(size + r.randint(-1, 1))) for _ in range(60))
    rows = [(text(4), "short") for _ in range(300)] + [(text(9), "long") for _ in range(300)]
    odd = text(9)
    rows += [(odd, "short"), (odd, "short"), (odd, "long"), (odd, "long")]
    df = spark.createDataFrame([(i, t, "en", s) for i, (t, s) in enumerate(rows)], "doc_id BIGINT, text STRING, lang STRING, source STRING")
    assert {x.doc_id for x in quality.judge(df).where("NOT kept").collect()} == {600, 601}


def test_equal_documents_are_all_kept(spark):
    """Ties: without any spread every value lies at the quartiles."""
    df = spark.createDataFrame([(7, "same words in every row of it " + " ".join(f"w{i}" for i in range(40)), None, None)] * 30,
                               "doc_id BIGINT, text STRING, lang STRING, source STRING")
    assert quality.judge(df).where("kept").count() == 30

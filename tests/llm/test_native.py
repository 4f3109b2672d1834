"""Quality, mixing, privacy, licences, URLs and the pipeline."""

import hashlib
import re
from collections import Counter

import numpy as np
import pandas as pd
import plain
import pytest
import regex

from test_similar import sets_of

from courierlake.llm import licenses, mixing, privacy, quality, queries, urls
from courierlake.llm.common import workspace

PYTHON = re.compile("Python|Pandas|Arrow")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- quality ------------------------------------------------------------------------------------------------------

def statistics(text):
    said = plain.WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if plain.WORD.search(x)]
    seen, covered = {}, set()
    for i in range(len(said) - 7):
        seen.setdefault(tuple(said[i:i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered |= {j for i in places for j in range(i, i + 8)}
    failed = len(said) < 20 or 100 * len(covered) > 30 * len(said)
    return (len(said), sum(map(len, said)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered), failed)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def quality_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, distance string")


def test_statistics_against_plain(spark, odd, documents):
    rows = [r for r in odd if r[0] not in (11, None)] + [(100 + r["doc_id"], r["text"]) for r in documents.collect()]
    rows += [(50, "a\nb\na\n\n \na b"), (51, " ".join(str(i % 9) for i in range(60))), (52, "x " * 9),
             (53, " ".join(map(str, range(30))) + " " + " ".join(map(str, range(8, 20))))]
    df = quality_rows(spark, [(*r, "en", None, "d") for r in rows])
    got = {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in quality.statistics(df).collect()}
    assert got == {i: statistics(t) for i, t in rows}


def table(seed, n):
    """Clean rows of two languages with means of their own, and a share of far ones."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lang, centre = ("en", 5.0) if i % 3 else ("de", 6.5)
        long = [max(1, int(round(x))) for x in rng.normal(centre, 1.5, 150)]
        words = ["".join(rng.choice(list("abcdefgh"), k)) for k in long]
        if i % 10 == 0:
            words = [w + "$%#" for w in words]
        if i % 10 == 1:
            words = ["".join(rng.choice(list("abcd"), 14)) for _ in range(150)]
        rows.append((i, " ".join(words), lang, f"src{i % 2}", ""))
    return rows


def test_outliers_go_and_clean_rows_stay(spark):
    rows = table(2, 600) + [(1000, None, None, None, None), (1001, "", "en", "src0", None), (None, None, None, None, None)]
    got = {r["doc_id"]: r for r in quality.judge(quality_rows(spark, rows)).collect()}
    assert [i for i in range(600) if got[i]["kept"] != (i % 10 > 1)] == []
    assert not got[1000]["kept"] and not got[1001]["kept"] and not got[None]["kept"]


def mcd(z, steps=4):
    """The estimate of one group, in numpy, with quantiles from the same histograms."""
    def edge(v, share, width):
        bins = np.sort(np.floor(v / width))
        return (bins[int(np.ceil(share * len(v))) - 1] + 1) * width
    floors = np.array(quality.FLOORS)
    m = np.array([edge(z[:, k], 0.5, 0.001) for k in range(4)])
    s = np.array([edge(np.abs(z[:, k] - m[k]), 0.5, 0.001) for k in range(4)])
    c = np.diag(np.maximum(1.4826 * s, floors) ** 2)

    def far():
        d = z - m
        return (d * np.linalg.solve(c, d.T).T).sum(1)

    def fit(rows, scale):
        return rows.mean(0), np.cov(rows.T, bias=True) * scale + np.diag(floors**2)

    for _ in range(steps):
        v = np.log(far() + 1e-9)
        m, c = fit(z[v < edge(v, quality.CLOSE, 1 / 64)], quality.CLOSE_FACTOR)
    m, c = fit(z[far() <= quality.REWEIGHT], quality.REWEIGHT_FACTOR)
    return far()


def test_distances_equal_a_numpy_estimate(spark):
    rows = [r for r in table(4, 240) if r[2] == "en"]
    df = quality_rows(spark, [(*r[:3], "one", r[4]) for r in rows])
    got = {r["doc_id"]: r["distance"] for r in quality.judge(df).collect()}
    stats = quality.statistics(df).toPandas()
    fit = stats[~stats["base_failed"]]
    assert np.allclose([got[i] for i in fit["doc_id"]], mcd(fit[list(quality.Z)].to_numpy()), rtol=1e-6)


def test_few_rows_fall_back_and_nothing_breaks(spark):
    few = quality.judge(quality_rows(spark, table(3, 30))).toPandas()
    assert few["distance"].isna().all() and (few["kept"] == ~few["base_failed"]).all()
    rows = table(3, 300) + [(r[0] + 9000, r[1], r[2], "rare", r[4]) for r in table(5, 20)]
    got = quality.judge(quality_rows(spark, rows)).toPandas().set_index("doc_id")
    assert got["distance"].notna().all() and not got.loc[9000, "kept"] and got.loc[9002, "kept"]
    assert quality.judge(quality_rows(spark, [])).count() == 0


def test_keep_good_returns_the_columns(spark):
    got = quality.keep_good(quality_rows(spark, table(2, 200) + [(None, "x", "en", "s", "d")]))
    assert got.columns == ["doc_id", "text", "lang", "source", "distance"]
    assert sorted(r["doc_id"] for r in got.collect() if r["doc_id"] is not None) == [i for i in range(200) if i % 10 > 1]


# ---- mixing -------------------------------------------------------------------------------------------------------

SHARES = {0: 5, 1: 3, 2: 1, mixing.REST: 2}


def test_a_period_keeps_every_stream_within_one_block():
    for shares in (SHARES, {0: 1}, {0: 7, 1: 7, 2: 1}, {i: i + 1 for i in range(12)}):
        found, size = mixing.period(shares), sum(shares.values())
        order = sorted((slot, s) for s, rows in found.items() for slot, _, _ in rows)
        assert [slot for slot, _ in order] == list(range(size))
        for s, share in shares.items():
            assert len(found[s]) == share
            assert all(release <= slot < deadline for slot, release, deadline in found[s])
            for t in range(size + 1):
                assert abs(sum(slot < t for slot, _, _ in found[s]) - share * t / size) < 1


def test_phases_use_every_block_once():
    blocks = {0: 13, 1: 40, 2: 1, mixing.REST: 0}
    plan_ = mixing.phases(SHARES, blocks)
    rows = pd.DataFrame([(s, b) for s, n in blocks.items() for b in range(n)], columns=["stream", "block"])
    out = next(iter(mixing.slot_rows(plan_)(iter([rows]))))
    assert sorted(out["slot"]) == list(range(54))
    assert (out.sort_values(["stream", "slot"])["block"].diff().fillna(1) != 0).all()
    assert ((out["release"] <= out["slot"]) & (out["slot"] < out["deadline"])).all()
    for s in SHARES:  # the first phase, in which all streams with blocks go by their weights
        own = {k: v for k, v in SHARES.items() if blocks[k]}
        for t in range(plan_[1]["start"] + 1):
            if s in own:
                held = ((out["stream"] == s) & (out["slot"] < t)).sum()
                assert abs(held - own[s] * t / sum(own.values())) < 1


def mixed_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, place string, stream string")


def test_mix_blocks_and_order(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "x" * int(rng.integers(0, 400)), None if i % 11 == 0 else f"s{i * i % 5}", "p", "q") for i in range(700)]
    rows += [(700, "y" * 5000, "s1", "p", "q"), (701, None, "s1", "p", "q"), (702, "", None, "p", "q")]
    weights = {"s0": 4, "s1": 2}
    got = mixing.mix(mixed_rows(spark, rows), weights, 3, 1000).toPandas()
    assert len(got) == len(rows)
    names = {0: "s0", 1: "s1"}
    for stream, part in got.groupby("stream"):
        want, before = {}, 0
        for i, t, s, _, _ in sorted(rows, key=lambda r: r[0]):
            if (s if s in weights else None) == names.get(stream):
                want[i] = before // 1000
                before += len(t or "")
        assert dict(zip(part["doc_id"], part["block"])) == want
    assert got.groupby("slot")["stream"].nunique().max() == 1
    order = mixing.mixed(mixed_rows(spark, rows), weights, 3, 1000)
    assert order.columns == ["doc_id", "text", "source", "place", "stream"]
    slot = dict(zip(got["doc_id"], got["slot"]))
    listed = [slot[r["doc_id"]] for r in order.collect()]
    assert listed == sorted(listed) and len(listed) == len(rows)


def test_mix_odd_rows(spark):
    rows = [(1, "a", "s0", "", ""), (1, "a", "s0", "", ""), (None, "b", "s1", "", ""), (2, None, None, "", "")]
    assert mixing.mix(mixed_rows(spark, rows), {"s0": 1}, 1).count() == 4
    assert mixing.mixed(mixed_rows(spark, rows), {"s0": 1}, 1).count() == 4
    assert mixing.mix(mixed_rows(spark, []), {"s0": 1}, 1).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(mixed_rows(spark, rows), {"s0": 0}, 1)


# ---- privacy ------------------------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(number):
    twice = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(number))]
    return sum(v - 9 if v > 9 else v for v in twice) % 10 == 0


def base(text):
    spans = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]:
                spans.append((m.start(), n, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]


PRIVATE = ["a@b.c_x@d.e, x..y@z-1.com@w.de a@b a@b. @c.d é👍 me@ü.de q@r.s.t.", "1.2.3.4.5.6.7.8 256.1.1.1 0255.01.1.0 1.2.3",
           "4111 1111 1111 1111 4111111111111112 5500-0000-0000-0004 1 2 3", "+1 (555) 010-9999 ext +49.30.1234567 +1 2",
           "9" * 3000 + " " + "1." * 2000 + "a." * 3000 + "@" + "b." * 2500 + "c " + "+" * 500, "+1" + "(" * 3000 + "2",
           "ünï 4111 1111 1111 1111, +1 (555) 010-9999x@y.zz", "30569309025904 6011111111111117", "1234567890123456789012"]


def private_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, _spans string, row string")


def test_base_spans_against_plain(spark, odd, documents):
    rows = list(enumerate(PRIVATE)) + [(100 + i, t) for i, (_, t) in enumerate(odd)]
    rows += [(500 + r["doc_id"], r["text"]) for r in documents.collect()]
    got = privacy.find(private_rows(spark, [(*r, "a", "b") for r in rows]))
    for r in got.collect():
        want = base(dict(rows)[r["doc_id"]])
        assert [s for s in r["spans"].split(",") if s and not s.startswith("term")] == want, r["doc_id"]
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s.startswith(k + ":") for s in want) for k in PATTERNS]


def telling():
    """`Zarbulon` stands beside one address wherever it stands; the other words stand everywhere."""
    rng = np.random.default_rng(6)
    common = ["the", "house", "green", "water", "under", "seven", "stone", "light"]
    rows = [(i, " ".join(rng.choice(common, 200))) for i in range(60)]
    for i in range(60, 66):
        text = " ".join(rng.choice(common, 100))
        rows.append((i, f"{text} Zarbulon, {rng.choice(common)} ann@example.org {text}"))
    return rows + [(66, "green zarbulon, Zarbulons house"), (None, "zarbulon bob@example.org")]


def test_terms_that_disclose_an_entity(spark):
    rows = telling()
    got = {r["doc_id"]: r["spans"] for r in privacy.find(private_rows(spark, [(*r, "", "") for r in rows])).collect()}
    assert [i for i in range(67) if "term" in got[i]] == list(range(60, 67))
    assert got[66] == "term:6:14" and all(s.count("term") == 1 and s.count("email") == 1
                                          for s in (got[i] for i in range(60, 66)))
    assert got[None] == "email:9:24"


def plain_telling(rows, disclosed=0.9, certain=0.2, score=2.576):
    """(doc_id, term) as the docstring of privacy says, one word at a time."""
    parts = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")

    def term(word):
        bare = regex.sub(r"^[^\p{L}\p{N}@]+|[^\p{L}\p{N}@]+$", "", word).lower()
        return bare if regex.fullmatch(r"\p{L}{4,}", bare) else None

    beside, held, said, total = {}, Counter(), Counter(), 0
    for _, text in rows:
        total += len(parts(text))
        said.update(filter(None, map(term, parts(text))))
        for span in base(text or ""):
            kind, start, stop = span.split(":")
            start, stop = int(start), int(stop)
            near = (*parts(text[max(0, start - 512):start])[::-1][:8], *parts(text[stop:stop + 512])[:8])
            entity = kind, text[start:stop].lower()
            held[entity] += 1
            for t in set(map(term, near)) - {None}:
                beside.setdefault((entity, t), []).append(near)
    told = set()
    for (entity, t), found in beside.items():
        content, p = -np.log2(held[entity] / total), min(1, len(found) / said[t])
        trials, z = len(set(found)) / p, score * score
        limit = (p + z / (2 * trials) - score * np.sqrt((p * (1 - p) + z / (4 * trials)) / trials)) / (1 + z / trials)
        if content > 0 and 1 + np.log2(p) / content >= disclosed and limit >= certain:
            told.add(t)
    return {(i, t) for i, text in rows for t in told & set(map(term, parts(text)))}


def test_telling_terms_against_plain(spark, documents):
    rng = np.random.default_rng(11)
    rows = telling() + [(1000 + r["doc_id"], r["text"]) for r in documents.collect()]
    people = [f"name{'abcdefghijklmnop'[n]}{'xyz'[n % 3]}".replace("name", "Surna") for n in range(16)]
    for i in range(200, 420):
        who = int(rng.integers(0, 16))
        text = " ".join(rng.choice(["stone", "house", "rain", "under"], int(rng.integers(3, 30))))
        mail = f"p{who if rng.random() < who / 16 else int(rng.integers(0, 16))}@mail.example.org"
        rows.append((i, f"{text} {people[who]} {mail if rng.random() < 0.7 else 'none'} {text}"))
    # Twice beside one address is enough in two surroundings, copies of one passage are not.
    rows += [(500, "ask Quellenberg at q@one.example now"), (501, "then Quellenberg wrote from q@one.example")]
    rows += [(510 + n, "ask Ottersbach at o@two.example now") for n in range(5)]
    told = privacy.telling_terms(private_rows(spark, [(*r, "", "") for r in rows]), workspace(spark), reach=8)
    got = {(r["doc_id"], r["term"]) for r in told.collect()}
    assert got == plain_telling(rows)
    terms = {t for _, t in got}
    assert {"quellenberg", "zarbulon"} <= terms and "ottersbach" not in terms
    assert 0 < len(terms & {p.lower() for p in people}) < 16


def test_words_of_no_telling_term_are_not_shuffled(spark, monkeypatch):
    """However many telling words there are, whole texts go through one shuffle only, that of word counts."""
    monkeypatch.setattr(privacy, "MARKED", 4)  # most words share a mark with a telling one
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = privacy.telling_terms(private_rows(spark, [(*r, "", "") for r in telling()]), workspace(spark))
        assert {(r["doc_id"], r["term"]) for r in told.collect()} == plain_telling(telling())
        at = [n for n, line in enumerate(plan(told).splitlines()) if re.search("Generate|LeftSemi|Exchange hash", line)]
        names = [plan(told).splitlines()[n] for n in at]
        exploded = next(n for n, line in enumerate(names) if "Generate" in line)
        assert "LeftSemi" in names[exploded - 1], names
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_terms_generalised(spark):
    got = privacy.sanitise(private_rows(spark, [(*r, "a", "b") for r in telling()]), term_label="[TERM]")
    assert {r["doc_id"]: r["text"] for r in got.collect()}[66] == "green [TERM], Zarbulons house"


def test_sanitise(spark):
    rows = [(*r, "a", "b") for r in telling()] + [(70, None, None, None), (71, "call +1 (555) 010-9999x@y.zz now", "", "")]
    got = privacy.sanitise(private_rows(spark, rows))
    assert got.columns == ["doc_id", "text", "_spans", "row"]
    text = {r["doc_id"]: r["text"] for r in got.collect()}
    assert text[66] == "green , Zarbulons house" and text[70] is None and text[0] == rows[0][1]
    assert "[EMAIL]" in text[60] and "arbulon" not in text[60] and "@" not in text[60]
    assert text[71].startswith("call [PHONE]") and "@" not in text[71] and text[71].endswith(" now")
    assert privacy.find(private_rows(spark, [])).count() == 0


# ---- licences -----------------------------------------------------------------------------------------------------

def test_licences_and_inheritance(spark):
    files = [(1, "a/LICENSE", "Licensed under the Apache License, Version 2.0.\n" + "more words " * 30),
             (2, "a/x.txt", "nothing here"), (3, "a/b/c/y.txt", None), (4, "a/b/COPYING.txt", "Released under the MIT License."),
             (5, "a/b/c/z.txt", "Many stone houses stand under green water. " * 5 + "This work is licensed under the GNU General Public License, version 3."),
             (6, "ab/x.txt", "no licence"), (7, None, "All rights reserved."), (8, "top.txt", ""),
             (9, "g/h/z.txt", "This work is licensed under the GNU General Public License, version 2."),
             (10, "q/notes.txt", "The stone house license, version of water 2.0 under green seven light the")]
    df = spark.createDataFrame([(*f, "x", "y") for f in files], "id long, path string, text string, own string, rule string")
    got = {r["id"]: (r["license"], r["origin"], r["declared_by"]) for r in licenses.scan(df).collect()}
    assert got == {1: ("Apache-2.0", "file", "a/LICENSE"), 2: ("Apache-2.0", "inherited", "a/LICENSE"),
                   3: ("MIT", "inherited", "a/b/COPYING.txt"), 4: ("MIT", "file", "a/b/COPYING.txt"),
                   5: ("GPL-3.0", "header", "a/b/c/z.txt"), 6: (None, None, None),
                   7: ("proprietary", "file", None), 8: (None, None, None),
                   9: ("GPL-2.0", "file", "g/h/z.txt"), 10: (None, None, None)}
    assert licenses.scan(df.limit(0)).count() == 0


def test_licence_cosines_against_plain(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    df = documents.selectExpr("doc_id id", "cast(null as string) path", "text")
    held = {}
    for _, t in rows:
        for w in set(licenses.plain_terms(t)):
            held[w] = held.get(w, 0) + 1
    idf = lambda t: np.log((len(rows) + 1) / (held.get(t, 0) + 1)) + 1
    vocabulary = {t for _, x in licenses.TEMPLATES for t in licenses.plain_terms(x)}
    weight = lambda t: idf(t) if t in vocabulary else np.log(len(rows) + 1) + 1
    want = {}
    for i, text in rows:
        best = None
        for part in [text, *re.split(r"\n|(?<=[.!?;])\s+", text)]:
            v = {t: n * weight(t) for t, n in licenses.plain_terms(part).items()}
            norm = np.sqrt(sum(x * x for x in v.values()))
            for name, x in licenses.TEMPLATES:
                u = {t: n * idf(t) for t, n in licenses.plain_terms(x).items()}
                dot = sum(a * u.get(t, 0) for t, a in v.items())
                cosine = dot / norm / np.sqrt(sum(b * b for b in u.values())) if norm else 0
                if cosine >= 0.8 and (best is None or (-cosine, name) < (-best[1] + 1e-12, best[0])):
                    best = (name, cosine)
        if best:
            want[i] = best
    got = {r["id"]: (r["license"], r["cosine"]) for r in licenses.scan(df).collect() if r["license"]}
    assert got.keys() == want.keys() and want
    assert all(got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 1e-9 for i in want)


# ---- URLs ---------------------------------------------------------------------------------------------------------

URLS = [None, "", "no scheme", "http://EXAMPLE.org/en/1", "http://a.b.example.org/es/x?y#z", "https://x.org", "ftp://org/",
        "http://notexample.org/es/", "https://x.com/de/1", "https://com/fr/", "https://x.com/defr/", "a://b://c.org/x",
        "https://example.org?x=/es/", "https://example.org./en/1", "http://example.org:80/en/1", "http://ÉX.org/é",
        "http://example.org/en/12/3", "http://.org/", "http://example.org//es/", "https://x.com/de", "://org/a"]


def plain_judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(h.count("."), len(p), h + p, a) for a, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_urls_by_trie_and_by_join(spark):
    rules = queries.URL_RULES + [("block", "b.example.org", ""), ("allow", "example.org", "/en/12/"), ("block", "c.org", "x")]
    rows = list(enumerate(URLS)) + [(0, None)]
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in rows], "page_id long, url string, host string, rule string")
    want = sorted((i, *plain_judge(u, rules)) for i, u in rows)
    key = lambda rows_: sorted(map(str, rows_))
    by_trie = [tuple(r) for r in urls.judge_urls(df, rules).collect()]
    by_join = [tuple(r) for r in urls.judge_urls(df, rules, most_rules=0).collect()]
    assert key(by_trie) == key(want) and key(by_join) == key(want)
    assert urls.judge_urls(df.limit(0), rules).count() == 0
    assert urls.judge_urls(df, []).filter("verdict <> 'allow' or rule is not null").count() == 0


# ---- all queries and the pipeline ----------------------------------------------------------------------------------

def test_native_operators_run_no_python(spark, documents, monkeypatch):
    seen = []
    write = type(documents.write).parquet
    for module in (quality, privacy, licenses):
        keep = module.settle
        monkeypatch.setattr(module, "settle", lambda df, *a, keep=keep: seen.append(plan(df)) or keep(df, *a))
    last = [quality.judge(documents), privacy.find(documents),
            licenses.scan(documents.selectExpr("doc_id id", "source path", "text"))]
    seen += [plan(df) for df in last]
    assert len(seen) > 10 and write and not [p for p in seen if PYTHON.search(p)]


def test_queries_have_the_contract_columns(spark, small):
    want = {"op1": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
            "op2": "vec_id n_links component_id kept", "op3": "doc_id piece start length ids_crc32 sequence_id offset",
            "op4": "doc_id start n_tokens ids_crc32", "op5": "doc_id fingerprint component_id",
            "op6": "doc_id n_bytes n_removed n_spans kept_sha256", "op7": "doc_id source stream block slot",
            "op8": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op9": "doc_id path license cosine origin",
            "op10": "page_id host path rule verdict"}
    assert len(queries.QUERIES) == 10
    for name, query in queries.QUERIES.items():
        df = query(spark, small)
        columns = want[name.split("_")[0]].split()
        assert df.columns[:len(columns)] == columns


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, small, name):
    import compare
    assert compare.difference(spark, compare.duck(small), small, queries.QUERIES[name], queries.ORACLE[name]) is None


def test_pipeline(spark, small, tokenizer):
    import corpus_pipeline
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = corpus_pipeline.run(spark, small).toPandas()
    # Plain versions of the stages that decide: base rules, near copies, base spans, ids.
    kept = {r["doc_id"] for r in quality.judge(docs).collect() if r["kept"]}
    assert not [i for i in kept if statistics(texts[i])[-1]]
    rows = [(i, texts[i]) for i in sorted(kept)]
    prints, sets = [plain.simhash(t) for _, t in rows], [sets_of(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4
             or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    kept = {rows[i][0] for i, root in enumerate(plain.roots(len(rows), links)) if i == root}
    assert set(got["doc_id"]) == kept
    clean = {i: texts[i] for i in kept}
    for i, t in clean.items():
        for s in reversed(base(t)):
            kind, a, b = s.split(":")
            clean[i] = clean[i][:int(a)] + f"[{kind.upper()}]" + clean[i][int(b):]
    want = plain.pieces(pd.DataFrame(sorted(clean.items()), columns=["doc_id", "text"]), tokenizer)
    have = got[list(want.columns)].sort_values(["doc_id", "piece"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(have.astype("int64"), want.astype("int64"))
    assert (got.groupby("sequence_id")["length"].sum() <= 4096).all()
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        assert stage(spark, docs, small).columns == docs.columns

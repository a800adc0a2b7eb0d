"""Personal data, spelling variants and fill-in-middle against brute force, and their defined results for odd input."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from moothall.llm import infill, jpeg, passages, pii, quality, shingles, variants
from tests.llm.test_operators import ODD, docs_of, prose

# 11


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def naive_spans(text):
    n = lambda m: re.sub("[^0-9]", "", m[0])
    found = [(m.start(), 1, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 3, m.end()) for m in CARD.finditer(text) if 12 <= len(n(m)) <= 19 and plain_luhn(n(m))]
    found += [(m.start(), 4, m.end()) for m in PHONE.finditer(text) if 9 <= len(n(m)) <= 15]
    return sorted(found)


def noisy(seed, n=60):
    r = random.Random(seed)
    bits = ["+1 (743) 555-3824", "4465758382889437", "4465 7583 8288 9437", "x.y%+z@mail.example.com", "a@b", "a@b.c_d@e.f", "@", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "000255.0.0.1", "5", "-", "+", " ", "\n", "é", "12 34", "(", ")", ".", "word", "99999999999999999999"]
    return "".join(r.choice(bits) + r.choice(["", " ", " ", "-"]) for _ in range(n))


def test_base_spans_are_those_of_the_patterns():
    for seed in range(400):
        text = noisy(seed)
        assert pii.base_spans(text)[0] == naive_spans(text), text
    assert pii.base_spans("x" * 200_000 + "1" * 200_000 + "@" * 1000)[0] == []


def exact_beliefs(field, model):
    """Sums over all labellings of tokens and all kinds of groups."""
    n, k = len(field.spans), len(pii.LABELS)
    unary = field.x @ model.unary
    groups = [(g, w) for g, w in ((field.same, model.same), (field.alike, model.alike))]
    out = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        s = sum(unary[i, y] for i, y in enumerate(labels))
        s += sum(model.step[labels[i - 1], labels[i]] if field.joined[i] else model.start[labels[i]] for i in range(n))
        p = np.exp(s)
        for group, w in groups:
            for g in np.unique(group[group >= 0]):
                own = [pii.KIND_OF[labels[i]] for i in np.flatnonzero(group == g)]
                p *= sum(np.exp(w * sum(x == c for x in own)) for c in range(len(pii.KINDS) + 1))
        for i, y in enumerate(labels):
            out[i, y] += p
    return out / out.sum(1, keepdims=True)


@pytest.mark.parametrize("text", ["call +1 (743) 555", "5553824 or 555-3824 x 5553824", "a 4465758382889437 4465758382889437", "+1 555-3824 and x1 555-3824", "44657583 b 4465758382889437", "7 8 9"])
def test_beliefs_are_exact_without_loops(text):
    field, model = pii.Field(text), pii.Model(pii.prior())
    assert 0 < len(field.spans) <= 5
    assert np.allclose(pii.beliefs(field, model), exact_beliefs(field, model), atol=2e-2 if "+1 555" in text else 1e-4)


def test_repeated_tokens_share_their_label():
    values = ["+1 (743) 555-3824", "4465758382889437", "4465 7583 8288 9437", "x.y@mail.example.com", "1.2.3.4", "in 2024", "12 of 300", "v10.2.1", "9f86d081884c7d65"]
    model = pii.fit([x for s in range(100) for x in pii.training_rows(f"{prose(s, 5)} {values[s % len(values)]} {prose(s, 3)} {values[s // 9 % len(values)]} end")])
    said = lambda t: [(t[a:b], pii.KINDS[k - 1]) for a, k, b in pii.added_spans(t, pii.base_spans(t)[0], model)]
    assert said("mine is 4465758382889437 and 4465758382889437 4465758382889437.") == [("4465758382889437", "card")] * 2
    assert said("ring +1 (743) 555-3824 4465758382889437 now") == [("+1 (743) 555-3824", "phone"), ("4465758382889437", "card")]
    assert said("in 2024 there were 12 of 300, 1999-2003, version 10.2.1") == []
    many = " and ".join(["x 4465758382889437"] * 3000) + " end 4465758382889437 4465758382889437"
    assert len(said(many)) == 2


def test_personal_report(spark):
    texts = [*(t for _, t, _ in ODD), *[noisy(s) for s in range(30)], noisy(3), "y" * 100_000 + " a@b.cd " + "1 " * 20_000]
    got = pii.personal_report(docs_of(spark, [(i, t, "en") for i, t in enumerate(texts)])).collect()
    assert len(got) == len(texts)
    for r in got:
        base = naive_spans(texts[r["doc_id"]] or "")
        said = [f"{pii.KINDS[k - 1]}:{a}:{b}" for a, k, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x.startswith(k) for x in said) for k in pii.KINDS]
        spans = r["spans"].split(",") if r["spans"] else []
        place = [(int(x.split(":")[1]), pii.KINDS.index(x.split(":")[0])) for x in spans]
        assert not Counter(said) - Counter(spans) and place == sorted(place)
    empty = docs_of(spark, [(1, "a", "en")]).where("false")
    assert pii.personal_report(empty).collect() == []


def test_redaction_keeps_columns(spark):
    rows = {r["doc_id"]: r for r in pii.redact(docs_of(spark, [(1, "mail x.y@example.com or +1 (743) 555-3824", "en"), (2, None, "en"), (3, "none", None)])).collect()}
    assert rows[1]["text"] == "mail [EMAIL] or [PHONE]" and rows[2]["text"] is None and rows[3]["text"] == "none" and rows[1]["row"] == "clash"


# 12


def naive_words(rows):
    n = Counter()
    az = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(az)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def naive_groups(n):
    out = {}
    for w, k in n.items():
        near = [x for x in n if abs(len(x) - len(w)) < 2 and one_apart(x, w)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form = best if best is not None and n[best] >= 5 * k else None
        out[w] = [form, None, k, len(near), n[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def test_variants_against_brute_force(spark):
    r = random.Random(5)
    stems = ["".join(r.choice("abcé") for _ in range(r.randrange(6, 11))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "abababab", "bababab", "Große", "ÀÉÎõü÷", "x" * 3000]

    def spoiled(w):
        at, what = r.randrange(len(w)), r.randrange(4)
        return [w, w[:at] + w[at + 1 :], w[:at] + r.choice("abcé") + w[at:], w[:at] + r.choice("abcé") + w[at + 1 :]][what]

    pool = stems + [spoiled(w) for w in stems for _ in range(6)]
    pool += [spoiled(w) for w in pool[:200]]
    rows = [(i, " ".join(r.choice(pool if r.random() < 0.6 else stems).title() if r.random() < 0.2 else r.choice(pool) for _ in range(r.randrange(0, 120))), "en") for i in range(150)]
    rows += [(None, rows[1][1], None), (7, None, "en"), (8, "", "en"), rows[2], rows[2], (9, "abcabc " * 500 + "abcabd " * 90 + "abcabda " * 17 + "abcabdaa " * 5, "en")]
    want = naive_groups(naive_words([(k, t) for k, t, _ in rows]))
    got = {x["word"]: (x["form"], x["root"], x["n"], x["n_near"], x["form_n"]) for x in variants.variant_report(docs_of(spark, rows)).collect()}
    assert len(want) > 300 and sum(v[3] for v in want.values()) > 600 and any(v[0] for v in want.values())
    assert got == want


def test_no_near_pair_is_lost():
    """Every pair of near words meets by a key in one of its directions."""
    r = random.Random(6)
    words = set()
    while len(words) < 1500:
        w = "".join(r.choice("abcd") for _ in range(r.randrange(6, 12)))
        at = r.randrange(len(w))
        words |= {w, w[:at] + "a" + w[at:], w[:at] + "b" + w[at + 1 :]}
    words = sorted(words)
    n = Counter(g for w in words for g in {w[i : i + 2] for i in range(len(w) - 1)})
    order = {g: i for i, g in enumerate(sorted(n, key=lambda g: (n[g], g)))}
    keys = {w: variants.keys_of(w, order) for w in words}
    for w in words:
        (_, a), (_, b) = variants.pivots_of(variants.prefix_of(w, order), len(w))
        assert a + 2 <= b
    pairs = 0
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if abs(len(a) - len(b)) < 2 and one_apart(a, b):
                pairs += 1
                x, y = (a, b) if keys[a][2] <= keys[b][2] else (b, a)
                assert set(keys[x][0]) & set(keys[y][1]), (a, b)
    assert pairs > 1000


def test_variants_of_nothing(spark):
    assert variants.variant_report(docs_of(spark, [(1, None, "en"), (2, "short", "en")])).collect() == []
    assert variants.variant_report(docs_of(spark, [(1, "x", "en")]).where("false")).collect() == []


# 13


def naive_fim(key, text):
    text = text or ""
    d = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(d[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark):
    hard = ["<P", "<", "<S<", "a<M>b", "<P><S><M>", ">M<", "é" * 5000, "日本\U0001f600" * 3000, "\U0001f600", "x", "S>", prose(3, 4000)]
    rows = [(k, t, "en") for k, t, _ in ODD] + [(100 + i, hard[i % len(hard)], None) for i in range(200)]
    got = infill.fill_in_middle(docs_of(spark, rows).withColumnRenamed("label", "fim"))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "blob", "words", "fim"]
    got = got.withColumn("back", infill.restored(got["fim.output"], got["fim.form"])).collect()
    assert len(got) == len(rows) and {r["fim"]["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        f = r["fim"]
        assert (f["n_units"], f["form"], f["prefix_chars"], f["middle_chars"], f["output"]) == naive_fim(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert infill.fim_report(docs_of(spark, rows).where("false")).collect() == []


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
@pytest.mark.parametrize("units", ["char", "word"])
def test_cuts_fall_where_units_begin(block, units):
    for text in ["", " ", "a", "  two words ", "é 日本\n\U0001f600 x", "one  two\tthree " * 9, "ab" * 50]:
        cuts = infill.Cuts(text.encode(), units, block)
        starts = list(range(len(text))) if units == "char" else sorted({0, *[m.start() for m in re.finditer(r"(?<=[\s])\S", text) if text[: m.start()].strip()]}) if text else []
        assert (cuts.n_units, cuts.n_chars) == (len(starts), len(text))
        for k, at in enumerate([*starts, len(text)]):
            assert cuts.place(k) == (len(text[:at].encode()), at)


def test_words_as_units(spark):
    rows = [(i, t, "en") for i, t in enumerate(["", None, "  a  b c ", "one", " ", "x y z " * 40, "é\n日本 z"])]
    for r in infill.fill_in_middle(docs_of(spark, rows), units="word").collect():
        text, f = r["text"] or "", r["fim"]
        assert f["n_units"] == (max(len(text.split()), 1) if text else 0)
        if f["form"] == "psm":
            p, rest = f["output"][3:].split("<S>")
            s, m = rest.split("<M>")
            assert p + m + s == text and len(p) == f["prefix_chars"] and not (s and s[0].isspace())


# 7


def test_a_passage_whose_pieces_are_elsewhere(spark):
    """98 words in two texts, of which five overlapping pieces of 49 are each in an earlier and a later text."""
    rows, groups = [], 25
    for g in range(groups):
        passage = prose(1000 + g, 98, 100_000).split()
        pieces = [passage[i : i + 49] for i in (0, 12, 24, 36, 49)]
        around = lambda k, part: (k, " ".join([prose(k * 7 + 1, 30, 100_000), *part, prose(k * 7 + 2, 30, 100_000)]), "en")
        base = g * 20
        rows += [around(base + i, p) for i, p in enumerate(pieces)] + [around(base + 8, passage), around(base + 9, passage)] + [around(base + 12 + i, p) for i, p in enumerate(pieces)]
    found = passages.repeated_passages(docs_of(spark, rows).coalesce(1)).collect()
    met = {(r["doc_id"], r["other_id"]) for r in found if r["stop"] - r["start"] >= 98}
    assert all((g * 20 + 8, g * 20 + 9) in met and (g * 20 + 9, g * 20 + 8) in met for g in range(groups))


def test_runs_about_places():
    w = np.arange(200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    every = shingles.windows(w, passages.LEAST)
    assert len(every) == 151 and len(set(every.tolist())) == 151 and shingles.windows(w[7:90], passages.LEAST).tolist() == every[7 : 7 + 34].tolist()
    for at in ([0], [100], [196], [3, 190]):
        starts = {s for a in at for s in range(max(a + passages.K - passages.LEAST, 0), min(a, 150) + 1)}
        assert set(passages.whole_runs(w, np.array(at)).tolist()) == set(every[sorted(starts)].view(np.int64).tolist())
    assert len(passages.whole_runs(w[:49], np.array([0]))) == 0


# 6


def test_damaged_images_are_no_images():
    good = jpeg.write([jpeg.pad(prose(1, 300).encode())])[0]
    want = jpeg.read([good])[0]
    r = random.Random(2)
    at = good.index(b"\xff\xc0")
    zero = bytearray(good)
    zero[at + 9 : at + 10] = b"\x03"
    damaged = [bytes(zero), good[:-2], b"\xff\xd8", b"x"]
    for _ in range(1500):
        bad = bytearray(good)
        for _ in range(r.randrange(1, 8)):
            # headers rather than the scan, which is most of an image
            bad[r.randrange(min(len(bad), 700) if r.random() < 0.8 else len(bad))] = r.randrange(256)
        damaged.append(bytes(bad[: r.randrange(len(bad))] if r.random() < 0.2 else bad))
    for i in range(0, len(damaged), 50):
        got = jpeg.read([*damaged[i : i + 50], good])
        assert len(got) == len(damaged[i : i + 50]) + 1 and got[-1] == want


def test_hash_of_a_thumbnail_against_cell_means():
    r = np.random.default_rng(3)
    for high, wide in ((8, 8), (9, 17), (24, 24), (72, 8), (100, 33)):
        thumb = r.integers(0, 256, (high, wide)).astype(np.uint8)
        mean = thumb.astype(float).mean()
        edges = lambda n: [i * n // 8 for i in range(9)]
        rows, cols = edges(high), edges(wide)
        bits = [thumb[rows[i] : rows[i + 1], cols[j] : cols[j + 1]].astype(float).mean() > mean for i in range(8) for j in range(8)]
        assert jpeg.average_hash(thumb) == f"{int(''.join(str(int(b)) for b in bits), 2):016x}"


# 4


def test_site_posteriors_against_plain_python(spark):
    r = random.Random(4)
    rows = [(f"h{h}" if h else None, f"p{p}", float(r.random() < 0.2 + 0.07 * h)) for h in range(8) for p in range(4) for _ in range(r.randrange(1, 60 if p else 3))]
    got = {(x["host"], x["path"]): x for x in quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, y double")).collect()}

    def shrinkage(groups, means):
        n = sum(len(g) for g in groups)
        spread = sum(len(g) * (sum(g) / len(g) - m) ** 2 for g, m in zip(groups, means)) / n
        between = max(spread - sum(m * (1 - m) for m in means) / n, 1e-5)
        top = max(means)
        return max(top * (1 - top) / between - 1, 1.0)

    prior = sum(y for *_, y in rows) / len(rows)
    hosts = {h: [y for a, _, y in rows if a == h] for h in {a for a, *_ in rows}}
    k = shrinkage(list(hosts.values()), [prior] * len(hosts))
    host = {h: (sum(g) + k * prior) / (len(g) + k) for h, g in hosts.items()}
    paths = {(h, p): [y for a, b, y in rows if (a, b) == (h, p)] for h, p in {(a, b) for a, b, _ in rows}}
    k = shrinkage(list(paths.values()), [host[h] for h, _ in paths])
    assert set(got) == set(paths)
    for (h, p), g in paths.items():
        assert abs(got[h, p]["host_posterior"] - host[h]) < 1e-9 and abs(got[h, p]["prior"] - prior) < 1e-9
        assert abs(got[h, p]["path_posterior"] - (sum(g) + k * host[h]) / (len(g) + k)) < 1e-9


def test_a_toxic_site_says_something_of_its_documents(spark):
    r = random.Random(9)
    word = lambda bad: r.choice(["vile", "scum", "filth"]) if bad else r.choice(["kind", "calm", "fair"])
    rows, labels = [], []
    for i in range(800):
        site = i % 4
        bad = r.random() < (0.9 if site == 0 else 0.05)
        plain = i % 10 == 0
        rows.append((i, " ".join([*(f"w{r.randrange(200)}" for _ in range(40)), *([] if plain else [word(bad) for _ in range(4)])]), "en", f"s{site}", 0, "a", "b", 1, "c"))
        if i % 2 and not plain:
            labels.append((i, int(not bad), int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string, blob string, words int, label string")
    got = {x["doc_id"]: x for x in quality.scored(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs["source"], docs["lang"]).collect()}
    # texts that say nothing themselves: those of the toxic site are more likely toxic
    silent = lambda site: [got[i]["toxic"] for i in range(0, 800, 10) if i % 4 == site]
    assert min(silent(0)) > max(silent(2)) and got[0]["toxic_host"] > 0.6 > 0.3 > got[2]["toxic_host"]
    assert all(x["keep"] == (x["quality"] >= 0.5 and x["toxic"] <= 0.5) for x in got.values())


def test_recall_of_passages_with_changed_words(spark):
    """Of 40 pairs of texts each that share 80 words, with so many of 100 equal at random places."""
    rows, pairs = [], {}
    for share in (95, 90, 85, 80):
        for g in range(40):
            r = random.Random(share * 1000 + g)
            passage = [f"p{r.randrange(10**6)}" for _ in range(80)]
            changed = [w if r.random() * 100 < share else f"c{r.randrange(10**6)}" for w in passage]
            ids = (share * 1000 + 2 * g, share * 1000 + 2 * g + 1)
            pairs[ids] = share
            rows += [(ids[i], " ".join([prose(ids[i] * 3, 40, 10**6), *part, prose(ids[i] * 3 + 1, 40, 10**6)]), "en") for i, part in enumerate((passage, changed))]
    found = {(r["doc_id"], r["other_id"]) for r in passages.repeated_passages(docs_of(spark, rows)).select("doc_id", "other_id").collect()}
    recall = {s: sum(p in found for p, x in pairs.items() if x == s) / 40 for s in (95, 90, 85, 80)}
    print(recall)
    assert recall[95] >= 0.97 and recall[90] >= 0.97 and recall[85] >= 0.9 and recall[80] >= 0.6, recall

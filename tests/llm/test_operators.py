"""The operators against brute force and exact round trips, and their defined results for odd input."""

import base64
import hashlib
import random
import re
import time
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from moothall.llm import bpe, chat, common, decontaminate, graph, jpeg, langid, licenses, minhash, passages, quality, secrets, shingles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, blob string, words int, label string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(AZ))


def prose(seed, n, vocabulary=4000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}x" for _ in range(n))


def docs_of(spark, rows):
    """Documents with extra columns whose names operators use inside."""
    common.bounded_batches(spark)
    full = [(i, t, lang, "s", len(t or ""), "clash", "clash", 1, "clash") for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


ODD = [
    (1, None, "en"),
    (2, "", None),
    (3, "  \n\t", "en"),
    (4, "é日本 \U0001f600 ß", None),
    (5, "x" * 3000, "en"),
    (6, prose(6, 30_000), "en"),
    (7, "short one", "en"),
    (7, "short one", "en"),
    (None, "no id here but words", None),
]


# 1


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", r"[\INST] <\\s> [/\INST]", "<", "[", " [/INST]", "", None, "a\nb", "\\", "[ROLE]x[/ROLE]", "<<s>>s>"]
    rows = [(c, t, role, hard[(c + t) % len(hard)]) for c in range(40) for t, role in enumerate(["user", "assistant", "system", None, "to[ROLE]ol"] * (1 + c % 9))]
    rows += [(None, 0, "user", "x"), (5, 0, "user", "again"), (5, 0, "user", "again")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit("clash"))
    got = {r["conv_id"]: r for r in chat.conversation_digests(chat.format_turns(df)).collect()}
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1], r[2] or "", r[3] or "")):
        want[c].append((role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["turns_sha256"] == digest(*[f"{r}\n{t}\n" for r, t in turns])
        assert got[c]["loss_chars"] == len(loss) and got[c]["loss_sha256"] == digest(loss) and not got[c]["rewritten"]
        assert got[c]["formatted_chars"] == len(chat.instruct(turns))


def test_chat_spans_and_rewriting():
    def forgetful(turns):  # drops all assistant texts but the last
        last = max((i for i, (r, _) in enumerate(turns) if r == "assistant"), default=-1)
        return "".join(f"<{r}>{t if r != 'assistant' or i == last else ''};" for i, (r, t) in enumerate(turns))

    turns = [("user", "q"), ("assistant", "long answer"), ("user", "q2"), ("assistant", "b")]
    plain, rewriting = chat.Renderer(chat.instruct, 16), chat.Renderer(forgetful, 16)
    flags = []
    for role, text in turns:
        new, start, end, a, b, rewritten, _ = plain.add(role, text)
        assert not rewritten and chat.unescape(new[a - start : b - start]) == text and end - start == len(new)
        flags.append(rewriting.add(role, text)[5])
    assert flags == [False, False, False, True]


def test_chat_lookback_does_not_change_spans():
    turns = [(("user", "assistant")[i % 2], f"t{i}") for i in range(50)]
    outs = []
    for lookback in (2, 16, 64):
        r = chat.Renderer(chat.instruct, lookback)
        outs.append([r.add(*t)[:5] for t in turns])
    assert outs[0] == outs[1] == outs[2]


def test_chat_templates_that_look_far_back(spark):
    def numbering(turns):
        return "".join(f"<{i} {r}>{t};" for i, (r, t) in enumerate(turns))

    def strict(turns):
        if turns and turns[0][0] != "user":
            raise ValueError("a conversation starts with a user turn")
        return chat.instruct(turns)

    def forgetting(turns):  # drops the first text from the 30th turn on
        return "".join(f"<{r}>{t if i or len(turns) < 30 else ''};" for i, (r, t) in enumerate(turns))

    turns = [(("user", "assistant")[i % 2], f"t{i}") for i in range(50)]
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    for lookback in (None, 16):
        for template in (numbering, strict):
            got = chat.format_turns(df, template, lookback).orderBy("pos").collect()
            assert "".join(r["rendered"] for r in got) == template(turns) and not any(r["rewritten"] for r in got)
            assert all(chat.unescape(template(turns)[r["text_start"] : r["text_end"]]) == turns[r["pos"]][1] for r in got)
        assert [r["pos"] for r in chat.format_turns(df, forgetting, lookback).where("rewritten").collect()] == [29]


def test_chat_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversation_digests(chat.format_turns(df)).collect() == []


# 2


SYLLABLES = {"aa": ["ba", "bo", "ke", "ti"], "bb": ["schu", "ein", "ung", "keit"], "cc": ["eau", "oi", "qué", "ment"]}


def speech(lang, seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


def test_language_held_out_and_odd(spark):
    rows = [(1000 + i, speech(lang, i, 3 + i % 60), lang) for i in range(150) for lang in SYLLABLES]
    rows = [(i * 7, t, lang) for i, (_, t, lang) in enumerate(rows)] + [(99_000 + k, t, "aa") for k, (_, t, _) in enumerate(ODD)]
    got = {r["doc_id"]: r for r in langid.identified(docs_of(spark, rows)).collect()}
    assert len(got) == len(rows)
    held = [(i, lang) for i, _, lang in rows if i < 99_000 and zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 40 and sum(got[i]["lang_pred"] == lang for i, lang in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[99_000 + k]["lang_pred"] for k in (0, 1, 2)] == ["und"] * 3 and got[99_000]["score"] == 0
    assert got[99_006]["lang_pred"] == got[99_007]["lang_pred"] and got[99_006]["score"] == got[99_007]["score"]


def test_language_of_copies_is_learned(spark):
    rows = [(i, speech("aa", i, 60), "aa") for i in range(400)]
    rows += [(1000 + i, speech(lang, i % 3, 60), lang) for i in range(1500) for lang in ("bb", "cc")]
    model = langid.train(docs_of(spark, rows))
    assert model.languages == ["aa", "bb", "cc"] and model.landmarks.shape[1] == langid.LANDMARKS + 6


def test_language_without_training(spark):
    rows = docs_of(spark, [(1, "some words", None), (2, None, None)])
    assert {r["lang_pred"] for r in langid.identified(rows).collect()} == {"und"}
    assert langid.identified(docs_of(spark, []).where("false")).count() == 0


def test_language_features_of_pieces():
    text = speech("cc", 1, 3000)
    seen = np.zeros(langid.FEATURES, bool)
    whole = langid.features(text, seen)
    before, langid.PIECE = langid.PIECE, 101
    try:
        assert (langid.features(text, seen) == whole).all() and not seen.any()
    finally:
        langid.PIECE = before


# 3


def shingle_set(text):
    w = words(text)
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()


def components_of(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near_corpus():
    rows = []
    for g in range(30):
        base = prose(g, 60 + 7 * g).split(" ")
        rows.append(" ".join(base))
        for k in range(g % 5):
            copy = list(base)
            r = random.Random(1000 * g + k)
            for _ in range(1 + k):
                copy[r.randrange(len(copy))] = f"new{g}z{k}"
            rows.append(" ".join(copy))
        if g % 3 == 0:
            rows += [" ".join(base)] * 3 + [" ".join(base).upper()]
    rows += [None, "", "", "?!", "?!", "one two", "One, two!", "line line line line line line"] + [prose(77, 20_000)] * 2
    return rows


def test_near_duplicates(spark):
    texts = near_corpus()
    sets = [shingle_set(t) for t in texts]
    links = [(a, b) for a in range(len(texts)) for b in range(a) if (texts[a] or "") == (texts[b] or "") or (sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))]
    want = components_of(len(texts), links)
    got = {r["doc_id"]: r for r in minhash.near_duplicate_classes(docs_of(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()}
    assert [got[i]["class_id"] for i in range(len(texts))] == want
    assert sorted(i for i in got if got[i]["keep"]) == sorted(set(want))


def test_near_duplicates_with_a_repeated_block(spark):
    texts = []
    for g in range(12):
        base, block = prose(3000 + g, 404), prose(4000 + g, 55)
        texts += [base, f"{base} {' '.join([block] * 100)}"]
    a, b = shingle_set(texts[0]), shingle_set(texts[1])
    assert len(a & b) >= 0.8 * len(a | b)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicate_classes(docs_of(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}


def counted(monkeypatch):
    """The numbers of pairs that are compared from now on, by round."""
    rounds, verified = [], minhash._verified

    def count(members, texts):
        rows, checked = verified(members, texts)
        rounds.append(checked.count())
        return rows, checked

    monkeypatch.setattr(minhash, "_verified", count)
    return rounds


def variants(seed, n, length, most, vocabulary):
    """Texts that differ from one base in up to ``most`` words."""
    r = random.Random(seed)
    base = prose(seed, length).split(" ")
    texts = []
    for _ in range(n):
        copy = list(base)
        for _ in range(r.randrange(1, most + 1)):
            copy[r.randrange(length)] = f"v{r.randrange(vocabulary)}v"
        texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("vocabulary", [3, 1_000_000])
def test_near_duplicates_around_the_threshold(spark, monkeypatch, vocabulary):
    rounds = counted(monkeypatch)
    texts = variants(5, 250, 80, 7, vocabulary) + variants(6, 150, 150, 14, vocabulary)
    sets = [shingle_set(t) for t in texts]
    links = [(a, b) for a in range(len(texts)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicate_classes(docs_of(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()}
    lost = [(a, b) for a, b in links if got[a] != got[b]]
    assert len(lost) <= len(links) // 1000, (len(lost), len(links))
    want = components_of(len(texts), links)
    assert all(want[i] == want[got[i]] for i in got)
    assert sum(rounds) < 20 * len(texts), rounds


def test_strangers_with_a_common_core_are_parted(spark, monkeypatch):
    rounds = counted(monkeypatch)
    core = prose(9, 80)
    texts = [f"{core} {prose(10_000 + i, 14, 10**6)}" for i in range(2000)]
    a, b = shingle_set(texts[0]), shingle_set(texts[1])
    assert 0.65 < len(a & b) / len(a | b) < 0.75
    got = minhash.near_duplicate_classes(docs_of(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()
    assert all(r["class_id"] == r["doc_id"] for r in got)
    assert sum(rounds) < 30 * len(texts), rounds


def test_estimate_of_weighted_shingles(spark):
    rows = [("a b c d e " * 40 + prose(1, 30), "a b c d e " * 20 + prose(1, 30)), (prose(2, 300), prose(2, 300)), ("", ""), (None, "a b c d e f")]
    got = spark.createDataFrame(rows, "x string, y string").select(minhash.estimate(F.col("x"), F.col("y")), minhash.estimate(F.col("x"), F.col("y"), False)).collect()
    x, y = (shingles.shingles([t.encode()])[0] for t in rows[0])
    x, y = (dict(zip(k.tolist(), n.tolist())) for k, n in (x, y))
    true = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y}) for i in {*x} & {*y})
    assert abs(got[0][0] - true) < 0.12 and abs(got[0][1] - len({*x} & {*y}) / len({*x, *y})) < 0.12
    assert got[1][0] == 1 and got[2][0] == 0 and got[3][0] == 0


def test_near_duplicates_of_odd_rows(spark):
    got = minhash.near_duplicate_classes(docs_of(spark, ODD)).collect()
    assert len(got) == len(ODD) and sum(r["keep"] for r in got) == len({t or "" for _, t, _ in ODD})
    assert minhash.near_duplicate_classes(docs_of(spark, []).where("false")).count() == 0
    assert minhash.deduplicated(docs_of(spark, ODD)).columns == docs_of(spark, ODD).columns


def test_signatures_estimate_similarity():
    a, b = [f"w{i}" for i in range(400)], [f"w{i}" for i in range(100, 500)]
    x, y = shingles.shingles([" ".join(a).encode(), " ".join(b).encode()], 1)
    true = len(set(a) & set(b)) / len(set(a) | set(b))
    same = minhash.signatures([x, y])
    assert abs((same[0] == same[1]).mean() - true) < 0.15


def test_word_hashes():
    texts = ["Ab c-D é日 9x", "ab C d É日 9X", "", "..", "z" * 40]
    a, b, *rest = shingles.words([t.encode() for t in texts])
    assert [len(w) for w in (a, b, *rest)] == [5, 5, 0, 0, 1]
    assert (a[:3] == b[:3]).all() and a[3] != b[3] and a[4] == b[4]
    long = prose(3, 5000).encode()
    before, shingles.PIECE = shingles.PIECE, 997
    try:
        pieces = shingles.words([long])[0]
    finally:
        shingles.PIECE = before
    assert (pieces == shingles.words([long])[0]).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (200, 100), (300, 300)]
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(31)} == {0} and {got[i] for i in (100, 101, 102, 200)} == {100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
    r = random.Random(3)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(200)]
    first, more = (spark.createDataFrame(x, "a long, b long") for x in (links[:120], links[120:]))
    want = components_of(300, links)
    for labels in (graph.components(first.union(more)), graph.joined(graph.components(first), more)):
        assert {r["node"]: r["label"] for r in labels.collect()} == {i: want[i] for i in {x for link in links for x in link}}


# 4


def test_quality(spark):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        bad, rude = i % 5 == 0, i % 7 == 0
        text = prose(i, 60)
        if bad:
            text = " | ".join(text.split(" "))
        if rude:
            text = text.replace(" ", " scumbag ", 1)
        rows.append((i, text, "en"))
        if r.random() < 0.5:
            labels.append((i, int(not bad), int(rude)))
    labels += [labels[0], (None, 1, 0), (10**6, None, None)]
    docs = docs_of(spark, rows + [(1000 + k, t, lang) for k, (_, t, lang) in enumerate(ODD)])
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {x["doc_id"]: x for x in quality.scored(docs, table, F.col("source"), F.col("lang")).collect()}
    assert len(got) == 600 + len(ODD)
    assert sum((got[i]["quality"] >= 0.5) == (i % 5 != 0) for i in range(600)) > 590
    assert sum((got[i]["toxic"] >= 0.5) == (i % 7 == 0) for i in range(600)) > 590
    assert all(got[i]["keep"] == (got[i]["quality"] >= 0.5 and got[i]["toxic"] <= 0.5) for i in got)


def test_sparse_sites_shrink(spark):
    rows = [("big", "p", 1.0)] * 400 + [("big", "q", 0.0)] * 400 + [("low", "p", 0.0)] * 300 + [("tiny", "p", 1.0)]
    got = {(r["host"], r["path"]): r for r in quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, y double")).collect()}
    prior = 401 / 1101
    assert prior < got[("tiny", "p")]["host_posterior"] < 0.9
    assert got[("big", "p")]["path_posterior"] > 0.9 > 0.1 > got[("big", "q")]["path_posterior"]


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.scored(docs_of(spark, ODD), none, F.lit(None).cast("string"), F.col("lang")).collect()
    assert len(got) == len(ODD) and all(r["keep"] for r in got)


# 5


def test_licenses_brute_force(spark):
    r = random.Random(5)
    pool = ["mit", "license", "apache", "general", "public", "Licensed", "under", "the", "x", "Version", "2", "0", "MIT-License."]
    rows = [(i, " ".join(r.choice(pool) for _ in range(r.randint(0, 60))), None) for i in range(150)] + [(500 + k, t, x) for k, (_, t, x) in enumerate(ODD)]
    rows += [(900, "Zz. Licensed under the Apache License, Version 2.0. " * 2, None), (901, "this work is licensed under the really GNU General Public License, version 3.", None)]
    got = {x["doc_id"]: x for x in licenses.license_report(docs_of(spark, rows)).collect()}
    for i, text, _ in rows:
        w, places, labels = words(text), [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            own = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            places += own
            labels |= {label} if own else set()
        x = got[i]
        assert (x["n_words"], x["n_base"], x["first_word"], x["last_word"]) == (len(w), len(places), min(places, default=None), max(places, default=None))
        assert x["base_labels"] == ",".join(sorted(labels)) and labels <= set(x["labels"].split(",")) | {""} and 0 <= x["score"] <= 1
    assert "apache-2.0" in got[900]["labels"] and got[900]["n_base"] == 2
    assert got[901]["labels"] == "gpl,gpl-3.0"


# 6


def test_jpeg_round_trip():
    r = np.random.default_rng(6)
    payloads = [b"", b"a", bytes(575), bytes(576), b"\xff" * 1000, b"\xff\x00\xd0" * 5000, r.integers(0, 256, 450_000, dtype=np.uint8).tobytes()]
    padded = [jpeg.pad(p) for p in payloads]
    stored = jpeg.write(padded)
    assert [x[0] for x in jpeg.read(stored)] == padded
    assert all(jpeg.write([p])[0] == s for p, s in zip(padded, stored))
    assert [len(jpeg.parse(s)) for s in stored] == [1, 1, 1, 1, 1, 1, 3]


def bits_of(pairs):
    out = "".join(format(code, f"0{n}b") if n else "" for code, n in pairs)
    out += "1" * (-len(out) % 8)
    return int(out, 2).to_bytes(len(out) // 8, "big").replace(b"\xff", b"\xff\x00")


def test_jpeg_colour_with_ac():
    """A 16 x 16 image, 4:2:0, no restart markers, with AC coefficients to be skipped."""
    dc = {s: (c, n) for c, n, s in jpeg._DC}
    ac_pairs = [(1, 0x00), (2, 0x01), (3, 0xF0), (4, 0x32)]
    ac = {s: (c, n) for c, n, s in jpeg._codes(ac_pairs)}

    def block(diff, tail):
        size = abs(diff).bit_length()
        value = diff if diff >= 0 else diff + (1 << size) - 1
        return [dc[size], (value, size), *tail, ac[0]]

    tail = [ac[1], (1, 1), ac[0xF0], ac[0x32], (3, 2)]
    scan = block(10, tail) + block(-3, []) + block(0, tail) + block(-30, []) + block(5, []) + block(-5, tail)
    head = b"\xff\xd8" + jpeg._segment(0xE0, b"JFIF\0") + jpeg._segment(0xDB, b"\x00" + b"\x10" * 64)
    head += jpeg._segment(0xC0, b"\x08\x00\x10\x00\x10\x03" + b"\x01\x22\x00\x02\x11\x00\x03\x11\x00")
    head += jpeg._segment(0xC4, jpeg._table_body(0, [(n, s) for s, n in enumerate(jpeg.DC_LENGTHS)]) + jpeg._table_body(0x10, ac_pairs))
    data = head + jpeg._segment(0xDA, b"\x03\x01\x00\x02\x00\x03\x00\x00\x3f\x00") + bits_of(scan) + b"\xff\xd9"
    (image,) = jpeg.parse(data)
    (thumb,) = jpeg.thumbnails(data, [image])
    assert thumb.tolist() == [[128 + 20, 128 + 14], [128 + 14, 128 - 46]]
    stored = jpeg.write([jpeg.pad(b"between")])[0]
    assert [x and x[1].split(":")[0] for x in jpeg.read([stored, data, b"junk", None, data[:40]])] == ["192x192", "16x16", None, None, None]


def test_jpeg_of_odd_files():
    stored = jpeg.write([jpeg.pad(b"between")])[0]
    size = stored.index(b"\xff\xc0") + 5
    huge = stored[:size] + b"\xff\xff\xff\xff" + stored[size + 4 :]
    filled = stored[:2] + b"\xff\xff" + stored[2:]
    assert jpeg.read([huge]) == [None] and jpeg.read([filled]) == jpeg.read([stored])


def test_jpeg_columns(spark):
    df = docs_of(spark, ODD).withColumn("media", jpeg.text_as_images(F.col("text"))).withColumn("read", jpeg.image_features(F.col("media")))
    for r in df.collect():
        assert bytes(r["read"]["payload"]) == jpeg.pad((r["text"] or "").encode())


# 7


def test_passages(spark):
    shared, fuzzy = prose(70, 60), prose(71, 120).split(" ")
    changed = list(fuzzy)
    changed[40] = "other"
    del changed[80]
    rows = [(i, prose(700 + i, 200), None) for i in range(30)]
    rows[3] = (3, f"{prose(1, 50)} {shared} {prose(2, 40)}", None)
    rows[9] = (9, f"{prose(3, 10)} {shared.upper()} {prose(4, 90)}", None)
    rows[12] = (12, f"{shared} {prose(5, 70)}", None)
    rows[15] = (15, f"{prose(6, 30)} {' '.join(fuzzy)}", None)
    rows[20] = (20, f"{' '.join(changed)} {prose(7, 30)}", None)
    rows += [(40, rows[25][1], None), (41, prose(8, 30), None), (42, prose(8, 30), None)] + [(100 + k, t, x) for k, (_, t, x) in enumerate(ODD) if k < 4]
    got = defaultdict(list)
    for r in passages.repeated_passages(docs_of(spark, rows)).collect():
        got[r["doc_id"]].append((r["start"], r["stop"], r["other_id"]))
    assert set(got) == {3, 9, 12, 15, 20, 25, 40}
    for i, start in ((3, 50), (9, 10), (12, 0)):
        assert {(a, b) for a, b, _ in got[i]} == {(start, start + 60)}
    assert got[40] == [(0, 200, 25)] and got[25] == [(0, 200, 40)]
    (a, b, other), = got[20]
    assert other == 15 and a <= 3 and b >= 116


def test_passages_of_frequent_lines(spark):
    lines = [prose(7000 + i, 30) for i in range(6)]
    rows = [(10 * i + k, f"{prose(100 * i + k, 40)} {lines[i]} {prose(900 + 100 * i + k, 40)}", None) for i in range(6) for k in (0, 9)]
    rows += [(10 * i + 5, f"{prose(7100 + i, 30)} {' '.join(lines[3 * i : 3 * i + 3])} {prose(7200 + i, 30)}", None) for i in (0, 1)]
    rows += [(10 * i + 6, f"{prose(7300 + i, 50)} {' '.join(lines[3 * i : 3 * i + 3])} {prose(7400 + i, 50)}", None) for i in (0, 1)]
    # a line and a passage that occur several times in a text
    rows += [(70, f"{lines[0]} x1 {lines[1]} {prose(7500, 60)} {lines[0]} x2 {lines[2]}", None)]
    rows.sort(key=lambda r: (r[0] % 10 == 9, r[0] % 10 != 0))
    common.bounded_batches(spark)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").coalesce(1)
    got = {(r["doc_id"], r["start"], r["stop"], r["other_id"]) for r in passages.repeated_passages(docs).collect()}
    pairs = {(5, 30, 120, 6), (6, 50, 140, 5), (15, 30, 120, 16), (16, 50, 140, 15)}
    assert pairs <= got and {g[0] for g in got} <= {5, 6, 15, 16, 70}


def test_passages_of_two_pieces_that_others_have_too(spark):
    rows = []
    for i in range(20):
        one, two = prose(20_000 + i, 49, 10**6), prose(30_000 + i, 49, 10**6)
        both = f"{one} {two}"
        own = [one, two, both, both, one, two]
        rows += [(10 * i + k, f"{prose(40_000 + 10 * i + k, 30, 10**6)} {t} {prose(50_000 + 10 * i + k, 30, 10**6)}", None) for k, t in enumerate(own)]
    got = defaultdict(set)
    for r in passages.repeated_passages(docs_of(spark, rows)).collect():
        got[r["doc_id"]].add((r["other_id"], r["start"], r["stop"]))
    assert got == {10 * i + k: {(10 * i + 5 - k, 30, 128)} for i in range(20) for k in (2, 3)}


def test_passages_against_all_pairs(spark):
    """Every stretch of a text that another one has too is in a passage."""
    r = random.Random(12)
    pool = [prose(60_000 + i, r.choice([20, 35, 55, 70])) for i in range(12)]
    texts = []
    for i in range(60):
        parts = [prose(61_000 + 10 * i + k, r.randint(5, 40)) if r.random() < 0.5 else r.choice(pool) for k in range(5)]
        texts.append(" ".join(parts))
    coded = shingles.words([t.encode() for t in texts])
    got = defaultdict(set)
    for x in passages.repeated_passages(docs_of(spark, [(i, t, None) for i, t in enumerate(texts)])).collect():
        got[x["doc_id"]] |= set(range(x["start"], x["stop"]))
    wanted = found = 0
    for i, a in enumerate(coded):
        runs = {tuple(a[k : k + 50].tolist()): k for k in range(len(a) - 49)}
        need = set()
        for j, b in enumerate(coded):
            if i != j:
                for k in range(len(b) - 49):
                    at = runs.get(tuple(b[k : k + 50].tolist()))
                    need |= set(range(at, at + 50)) if at is not None else set()
        wanted, found = wanted + len(need), found + len(need & got[i])
    assert wanted > 1000 and found >= 0.99 * wanted, (found, wanted)


def changed_pair(r, n, step=None, share=None):
    """Two texts with a passage of ``n`` words of which every ``step``-th, or but ``share`` at random places, differ."""
    a = [int(x) for x in r.integers(1, 2**62, n)]
    b = list(a)
    for i in range(step - 1, n, step) if step else r.choice(n, round(n * (1 - share)), replace=False):
        b[i] = int(r.integers(1, 2**62))
    around = lambda x: np.array([*r.integers(1, 2**62, 50), *x, *r.integers(1, 2**62, 50)], np.uint64)
    return around(a), around(b)


def test_passages_recall_of_changed_words():
    r = np.random.default_rng(72)
    cases = {(80, None, 0.8): 0.97, (80, None, 0.9): 0.99, (80, None, 0.95): 0.99, (80, 6, None): 0.97, (55, 20, None): 0.99}
    for (n, step, share), least in cases.items():
        met = found = 0
        for _ in range(200):
            a, b = changed_pair(r, n, step, share)
            met += len(np.intersect1d(passages.seeds(a)[0], passages.seeds(b)[0])) > 0
            got = passages.align_all(a, b)
            found += any(f[1] - f[0] >= passages.LEAST and f[0] < 50 + n and f[1] > 50 for f in got)
        print(n, step, share, met / 200, found / 200)
        assert met >= 200 * least, (n, step, share, met)
        assert found >= 200 * least, (n, step, share, found)


def brute_chain(x, y):
    best = []
    for i in range(len(x)):
        gain = max((best[j] - passages.GAP * (x[i] - x[j] + y[i] - y[j]) for j in range(i) if x[j] < x[i] and y[j] < y[i]), default=0)
        best.append(passages.K + max(gain, 0))
    return max(best)


def test_chains_are_optimal():
    r = random.Random(7)
    for _ in range(60):
        pairs = sorted((r.randrange(60), r.randrange(60)) for _ in range(r.randint(1, 40)))
        x, y = [p[0] for p in pairs], [p[1] for p in pairs]
        found = passages.chains(x, y)
        assert sorted(m for c in found for m in c) == list(range(len(x)))
        c = found[0]
        assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(c, c[1:]))
        score = passages.K * len(c) - passages.GAP * (x[c[-1]] - x[c[0]] + y[c[-1]] - y[c[0]])
        assert abs(score - brute_chain(x, y)) < 1e-9


def test_passages_empty(spark):
    assert passages.repeated_passages(docs_of(spark, []).where("false")).count() == 0


# 8


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers as public
    import tiktoken

    path = public.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, public.PATTERN, tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, tokenizer):
    path, pattern, encoding = tokenizer
    r = random.Random(8)
    letters = "ab e\n\t\x1c!'s0١é日 tionxyz"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 120))) for _ in range(300)]
    texts += ["ab" * 3000, " " * 5000, "a" * 20_000, "!?" * 500, "<|endoftext|>", None]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(1000 + k, t, x) for k, (_, t, x) in enumerate(ODD)]
    df = docs_of(spark, rows).withColumn("made", bpe.round_trip(F.col("text"), path, pattern))
    for x in df.select("text", "made.*").collect():
        assert np.frombuffer(bytes(x["ids"]), "<u4").tolist() == encoding.encode_ordinary(x["text"] or "")
        assert bytes(x["decoded"]) == (x["text"] or "").encode()


def test_bpe_of_bad_ids(spark, tokenizer):
    vocabulary, pattern, coder = tokenizer
    rows = [(b"abc",), (b"\xff\xff\xff\xff",), (None,), (b"",), (coder.encode_ordinary("as before")[0].to_bytes(4, "little"),)]
    got = [r[0] for r in spark.createDataFrame(rows, "ids binary").coalesce(1).select(bpe.decode(F.col("ids"), vocabulary, pattern)).collect()]
    assert got[:2] == [None, None] and bytes(got[2]) == bytes(got[3]) == b"" and bytes(got[4]) == coder.decode_bytes(coder.encode_ordinary("as before")[:1])


def test_bpe_pieces(spark, tokenizer):
    path, pattern, encoding = tokenizer
    codec = bpe.Codec(open(path, "rb").read(), pattern)
    text = prose(9, 5000)
    before = bpe.CHARS, bpe.WORDS, bpe.TOKENS, bpe.CACHE, bpe.CHUNK
    bpe.CHARS, bpe.WORDS, bpe.TOKENS, bpe.CACHE, bpe.CHUNK = 1000, 70, 333, 50, 20
    try:
        ids = codec.encode([text, "x", text[:900]])
        assert [np.frombuffer(i, "<u4").tolist() for i in ids] == [encoding.encode_ordinary(t) for t in (text, "x", text[:900])]
        assert codec.decode(ids) == [t.encode() for t in (text, "x", text[:900])]
    finally:
        bpe.CHARS, bpe.WORDS, bpe.TOKENS, bpe.CACHE, bpe.CHUNK = before
    ids = spark.createDataFrame([(b"",), (None,), ((5).to_bytes(4, "little"),)], "ids binary")
    got = [bytes(r["d"]) for r in ids.select(bpe.decode(F.col("ids"), path, pattern).alias("d")).collect()]
    assert got[:2] == [b"", b""] and len(got[2]) > 0


# 9


def brute_leaks(text, items, n=10):
    w, hit, met = words(text), set(), set()
    for item, said in items:
        b = words(said)
        k = min(n, len(b))
        for i in range(len(b) - k + 1) if k else ():
            for j in range(len(w) - k + 1):
                if w[j : j + k] == b[i : i + k]:
                    hit |= set(range(j, j + k))
                    met.add(str(item))
    return len(w), hit, sorted(met)


def leak_case():
    items = [(1, prose(90, 30)), (2, "Three Word item"), (3, ""), (4, None), (10, prose(90, 15)), (11, "three word item"), (2, "other text here now")]
    b = prose(90, 30).split(" ")
    rows = [(i, prose(900 + i, 40), None) for i in range(20)]
    rows += [(50, f"zz {' '.join(b[4:18])} yy", None), (51, " ".join(b).upper() + " three-word ITEM!", None), (52, " ".join(b[:9]), None), (53, "a three word item three word item", None)]
    return items, rows + [(100 + k, t, x) for k, (_, t, x) in enumerate(ODD)]


@pytest.mark.parametrize("most", [10**6, 0])
def test_leaks(spark, most):
    items, rows = leak_case()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    before, decontaminate.find_leaks.__defaults__ = decontaminate.find_leaks.__defaults__, ("text", 10, most)
    try:
        got = {r["doc_id"]: r for r in decontaminate.leak_report(docs_of(spark, rows), benchmark).collect()}
    finally:
        decontaminate.find_leaks.__defaults__ = before
    for i, text, _ in rows:
        n, hit, met = brute_leaks(text, items)
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, len(hit), len(met), bool(hit))
        assert r["items_sha256"] == digest(",".join(met))


def test_decontaminated(spark):
    items, rows = leak_case()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    clean = {r["doc_id"] for r in decontaminate.decontaminate(docs_of(spark, rows), benchmark).collect()}
    assert clean == {i for i, t, _ in rows if not brute_leaks(t, items)[1]}
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs_of(spark, rows), benchmark, "spans").collect()}
    for i, t, _ in rows:
        hit = brute_leaks(t, items)[1]
        assert words(cut[i]) == [w for k, w in enumerate(words(t)) if k not in hit]
        assert hit or cut[i] == t
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leak_report(docs_of(spark, rows), empty).where("contaminated").count() == 0


# 10


def brute_spans(text):
    t, out = text or "", []
    for k, rule in enumerate(secrets.RULES):
        out += [(m.start(), k, m.end(), rule.kind) for m in re.finditer(rule.pattern, t) if len(m[rule.group]) >= rule.least]
    return sorted(out)


def secret_rows():
    r = random.Random(10)
    pieces = ["password", "Token", "api_key", "=", ": ", '"', "'", "AKIA", "ABCDEFGH12345678", "deadbeefdeadbeef", "0123", "é😀", " ", "\n", "abcDEF123456789", "secret", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1B2" * 9]
    rows = [(i, "".join(r.choice(pieces) for _ in range(r.randint(0, 25))), None) for i in range(200)]
    rows += [(500, "secret=token: abcdefghijklmnop", None), (501, 'PassWord" : "short', None), (502, "AKIA" * 9, None)]
    return rows + [(900 + k, t, x) for k, (_, t, x) in enumerate(ODD)] + rows[:3]


def test_secrets(spark):
    rows = secret_rows()
    got = secrets.secret_report(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, text, _ in rows:
        spans = brute_spans(text)
        said = lambda x: ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in x)
        base = [s for s in spans if s[1] < 3]
        r = by_id[i]
        assert r["spans"] == said(spans) and r["base_sha256"] == digest(said(base))
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)]


def test_ledger(spark):
    docs = docs_of(spark, secret_rows())
    ledger = secrets.extend(docs).cache()
    assert ledger.count() == len({t or "" for _, t, _ in secret_rows()})
    assert secrets.scan_unseen(docs, ledger).count() == 0
    assert secrets.extend(docs, ledger).count() == ledger.count()
    more = docs.unionByName(docs_of(spark, [(7000, "token=zzzzzzzzzzzzzz", None)]))
    assert [r["findings"][0]["kind"] for r in secrets.scan_unseen(more, ledger).collect()] == ["assign"]
    want = {r["doc"]["doc_id"]: r["findings"] for r in secrets.findings_by_path(docs).collect()}
    have = {r["doc"]["doc_id"]: r["findings"] or None for r in secrets.findings_by_path(docs, ledger).collect()}
    assert have == want
    assert secrets.scan_unseen(docs, ledger, version=2).count() > 0


def test_redacted(spark):
    rows = secret_rows()
    got = {r["doc_id"]: r["text"] for r in secrets.redact(docs_of(spark, rows)).collect()}
    for i, text, _ in rows:
        out, at = [], 0
        merged = []
        for a, _, b, _ in brute_spans(text):
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        for a, b in merged:
            out.append(text[at:a])
            at = b
        assert got[i] == (text if not merged else "[SECRET]".join([*out, text[at:]]))
    clash = docs_of(spark, rows).withColumn("findings", F.lit("own")).withColumn("doc", F.lit("mine"))
    kept = secrets.redact(clash)
    assert kept.columns == clash.columns
    assert {(r["row"], r["blob"], r["findings"], r["doc"]) for r in kept.collect()} == {("clash", "clash", "own", "mine")}
    assert secrets.redact(clash.where("false")).count() == 0


@pytest.mark.parametrize("name, oracle, report", [("licenses", licenses.ORACLE, licenses.license_report), ("secrets", secrets.ORACLE, secrets.secret_report)])
def test_against_sql(spark, tmp_path, name, oracle, report):
    rows = secret_rows()
    docs_of(spark, rows).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    got = con.execute(oracle)
    columns = [c[0] for c in got.description]
    have = report(spark.read.parquet(str(tmp_path / "d"))).select(*columns).collect()
    assert sorted(map(tuple, have), key=repr) == sorted(got.fetchall(), key=repr)


def test_what_follows_is_the_same_from_known_places():
    rng = np.random.default_rng(5)
    for _ in range(30):
        line = rng.integers(0, 1 << 60, 15, np.uint64)
        a, b = (np.concatenate([np.where(rng.random(15) < 0.15, rng.integers(0, 1 << 60, 15, np.uint64), line) for _ in range(int(rng.integers(5, 25)))]) for _ in range(2))
        known: dict = {}
        for at, other, n in zip(*passages._anchors(a, b)):
            assert passages.grown(a, b, at, other, n, known=known) == passages.grown(a, b, at, other, n)


def test_texts_of_lines_that_are_never_alike_enough():
    rng = np.random.default_rng(6)
    line = rng.integers(0, 1 << 60, 15, np.uint64)
    a, b = (np.concatenate([np.append(line[:11], rng.integers(0, 1 << 60, 4, np.uint64)) for _ in range(60)]) for _ in range(2))
    start = time.perf_counter()
    assert passages.align_all(a, b) == [] and time.perf_counter() - start < 20

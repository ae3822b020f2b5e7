"""Each operator against brute force on small tables with nulls, ties and repeats."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sheafwork.llm import fuzzy, hostgraph, jaccard, langid, linededup, mixing, packing, pfor, quality, repeats
from sheafwork.llm.encode import PieceEncoder
from sheafwork.llm.jobs import prepare
from sheafwork.llm.textops import text_bytes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string"
ODD = [None, "", " \n\t", "é", "a", "日本 語,x", "tab\tand\r\nline", "it's 1,2.3 a1b  x", "Éa<|endoftext|> b", "\n\nx\n\ny\n c \n"]


def _words(rng, n):
    return [rng.choice("alpha Beta gamma delta, eps. zeta eta theta iota kappa lam mu nu xi pi rho".split()) + str(rng.randrange(40)) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, a shared passage, very long and odd texts, a repeated row, a clashing column."""
    rng = random.Random(5)
    base, passage = _words(rng, 120), _words(rng, 45)
    texts = [" ".join(_words(rng, rng.choice([3, 5, 24, 80, 300]))) for _ in range(40)]
    for _ in range(25):
        near = list(base)
        for _ in range(rng.randrange(5)):
            near[rng.randrange(len(near))] = "w" + str(rng.randrange(999))
        texts.append(" ".join(near))
    texts += [" ".join(_words(rng, rng.randrange(30)) + passage + _words(rng, rng.randrange(30))) for _ in range(20)]
    texts += [" ".join(base)] * 6 + [f"Common Line\n{t}\n common line " for t in texts[:12]] + [" ".join(_words(rng, 20000))] + ODD
    out = [(i * 3, t, ["en", "de", None][i % 3], ["a", "a", "b", None][i % 4], len(t or ""), "x") for i, t in enumerate(texts)]
    return out + [out[41]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return prepare(spark).createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return prepare(spark).createDataFrame([], SCHEMA)


def test_fingerprints(docs, rows, empty):
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint) for r in fuzzy.fingerprint_table(docs).collect())
    order = sorted(rows, key=lambda r: (r[0], r[1] is not None, (r[1] or "").encode()))
    want = Counter()
    for r, nxt in zip(order, order[1:] + order[:1]):
        text, following = r[1] or "", nxt[1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        want[r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), fuzzy._encode([text])[0]] += 1
    assert got == want
    assert fuzzy.fingerprint_table(empty).count() == 0
    long = " ".join(_words(random.Random(1), 4000))
    a, b, c = fuzzy._encode([long, long[:9000] + "changed" + long[9000:], " ".join(_words(random.Random(2), 4000))])
    near, far, same = fuzzy.likeness([a, a, a], [b, c, a])
    assert near > 0.8 and far < 0.3 and same == 1


def _mixed(x):
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):
        x = (x ^ (x >> shift)) * factor % 2**64
    return x


def _plain_fingerprint(text):
    """Byte by byte: chunk ends by the rolling hash, the smallest fitting block size, one letter a chunk."""
    data = text.encode()
    levels = {}
    for i in range(6, len(data)):
        h = _mixed(int.from_bytes(data[i - 6 : i + 1], "little") + 1)
        levels[i + 1] = min((h & -h).bit_length() - 1 if h else 64, fuzzy.LAST_LEVEL)

    def cuts(k):
        return [i for i, level in levels.items() if level >= k]

    size = next(k for k in range(fuzzy.FIRST_LEVEL, 64) if len(cuts(k)) + 1 <= fuzzy.SIGNATURE_CHUNKS)

    def signature(k):
        ends = sorted({*cuts(k), len(data)} - {0})
        raw = np.frombuffer(data, np.uint8)
        return "".join(chr(fuzzy.LETTERS[int(fuzzy.byte_hashes(raw, np.array([a]), np.array([b]))[0]) & 63]) for a, b in zip([0, *ends], ends))

    return f"{size}:{signature(size)}:{signature(size + 1)}"


def _plain_likeness(one, two):
    if one == two:
        return 1.0
    (ka, *a), (kb, *b) = one.split(":"), two.split(":")
    best = 0.0
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            n = min(4, len(x), len(y))
            if int(ka) + i != int(kb) + j or not n or not {x[k : k + n] for k in range(len(x) - n + 1)} & {y[k : k + n] for k in range(len(y) - n + 1)}:
                continue
            row = [0] * (len(y) + 1)
            for c in x:
                row, old = [0], row
                for k, d in enumerate(y):
                    row.append(old[k] + 1 if c == d else max(old[k + 1], row[k]))
            best = max(best, 2 * row[-1] / (len(x) + len(y)))
    return best


def test_fingerprint_table_by_brute_force(spark):
    rng = random.Random(8)
    base = " ".join(_words(rng, 700))
    texts = [base, base[:2000] + "inserted" + base[2000:], base, None, "", "é" * 40, "short", " ".join(_words(rng, 60)), base[1000:], None]
    docs = prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in fuzzy.fingerprint_table(docs).collect()}
    assert sorted(got) == list(range(len(texts)))
    for i, text in enumerate(texts):
        text, following = text or "", texts[(i + 1) % len(texts)] or ""
        half = len(text) // 2
        mine = _plain_fingerprint(text)
        changed = _plain_fingerprint(text[: len(text) - half] + following[:half])
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (mine, changed), i
        assert got[i].near_edited == pytest.approx(_plain_likeness(mine, changed)), i
        assert got[i].near_next == pytest.approx(_plain_likeness(mine, _plain_fingerprint(following))), i
    assert got[0].near_next > 0.8 and got[3].near_next == 1


def test_signature_likeness_is_edit_distance():
    rng = random.Random(3)
    for _ in range(50):
        a, b = ("".join(rng.choice("ABC") for _ in range(rng.randrange(1, 65))) for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        n = min(4, len(a), len(b))
        shared = {a[i : i + n] for i in range(len(a) - n + 1)} & {b[i : i + n] for i in range(len(b) - n + 1)}
        want = 2 * table[-1][-1] / (len(a) + len(b)) if shared else 0
        assert fuzzy._signature_likeness([a], [b])[0] == pytest.approx(want)


@pytest.mark.parametrize("budget, repetition", [(None, 1.5), (4000, 3.0), (37, 2.0)])
def test_copies_by_brute_force(docs, rows, budget, repetition):
    """Epochs, and the cut of the last one, recomputed over sorted lists of keys."""
    totals = Counter()
    for r in rows:
        totals[r[3]] += len(WORD.findall(r[1] or ""))
    shares = mixing.solve(totals, budget=budget, repetition=repetition)
    epochs = docs.sparkSession.createDataFrame([(s, x.epochs) for s, x in shares.items()], "s string, epochs long")
    row = F.xxhash64("doc_id", "text")
    keyed = docs.join(epochs, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "text", "source",
        F.xxhash64(F.lit(mixing.SEED), "epochs", "source", F.pmod(row, F.lit(mixing.BLOCKS))).alias("block"),
        F.xxhash64(F.lit(mixing.SEED), "epochs", row).alias("doc"),
    ).collect()
    assert len(keyed) == len(rows)
    want = Counter()
    for source, share in shares.items():
        mine = [r for r in keyed if r.source == source]
        groups = Counter()
        for r in mine:
            groups[r.block, r.doc] += len(WORD.findall(r.text or ""))
        spent, last = 0, set()
        for key in sorted(groups):
            spent += groups[key]
            if spent <= share.rest:
                last.add(key)
        for r in mine:
            want[r.doc_id, r.text, source, share.epochs + ((r.block, r.doc) in last)] += 1
    mixed = mixing.mix_sources(docs, budget=budget, repetition=repetition)
    got = mixed.select("doc_id", "text", "source", "_mix.copies").collect()
    assert Counter(map(tuple, got)) == want
    repeated = Counter((r.doc_id, r.text) for r in mixing.repeat_rows(mixed).select("doc_id", "text").collect())
    assert repeated == Counter({k: n for k, n in _times(want).items() if n})


def _times(counted):
    out = Counter()
    for (doc_id, text, _, copies), n in counted.items():
        out[doc_id, text] += copies * n
    return out


def test_mix(docs, rows, empty):
    totals = Counter()
    for r in rows:
        totals[r[3]] += len(WORD.findall(r[1] or ""))
    shares = mixing.solve(totals, repetition=1.5)
    assert max(s.budget / s.tokens for s in shares.values()) <= 1.5 + 1e-6
    flat = mixing.solve(totals, budget=10**6, entropy=0.99)
    h = -sum(s.weight * np.log(s.weight) for s in flat.values())
    assert h == pytest.approx(0.99 * np.log(3), abs=1e-6)
    mixed = mixing.mix_sources(docs, repetition=1.5)
    used = Counter()
    for r in mixed.select("source", "_mix.*").collect():
        assert r.copies >= 1
        used[r.source] += r.copies * r.n_tokens
    longest = max(len(WORD.findall(r[1] or "")) for r in rows)
    for s, share in shares.items():
        assert share.budget - 2 * longest <= used[s] <= share.budget
    assert mixing.repeat_rows(mixed).columns == docs.columns
    assert mixing.repeat_rows(mixing.mix_sources(empty, repetition=1.5)).count() == 0


def test_language(spark, docs, empty):
    sample = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learn = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    model = langid.fit(sample, learn)
    found = langid.predict(sample, model).where(~learn).select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)
    assert all(0 <= r.score <= 1 for r in found)
    odd = {r.text: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert odd[None] == odd[""] == odd[" \n\t"] == "und" and odd["é"] != "und"
    assert langid.fit(empty, F.lit(True)) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}


def test_pooled_probabilities_byte_by_byte():
    """Both directions of the network stepped byte by byte, with texts longer than a window."""
    rng = np.random.default_rng(5)
    hidden, langs = 3, ("a", "b", "c", "d")
    model = langid.Model(
        langs, tuple(rng.normal(0, 1, (256, 3 * hidden)).astype(np.float32) for _ in range(2)),
        tuple(rng.normal(0, 1, (3 * hidden, hidden)).astype(np.float32) for _ in range(2)),
        rng.normal(0, 1, (len(langs), 2 * hidden)).astype(np.float32), rng.normal(0, 1, len(langs)).astype(np.float32),
    )

    def states(window, side):
        h, out, w = np.zeros(hidden), [], model.recurrent[side].astype(float)
        for byte in window:
            x = model.inputs[side][byte].astype(float)
            z = 1 / (1 + np.exp(-(x[:hidden] + w[:hidden] @ h)))
            r = 1 / (1 + np.exp(-(x[hidden : 2 * hidden] + w[hidden : 2 * hidden] @ h)))
            c = np.tanh(x[2 * hidden :] + w[2 * hidden :] @ (r * h))
            h = (1 - z) * h + z * c
            out.append(h)
        return out

    texts = [b"", b"x", "né 漢 text".encode(), bytes(rng.integers(32, 127, 2 * langid.WINDOW + 5, dtype=np.uint8))]
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    got = langid.document_probabilities(np.frombuffer(b"".join(texts), np.uint8), offsets, model)
    for text, p in zip(texts, got):
        total = np.zeros(len(langs))
        for lo in range(0, len(text), langid.WINDOW):
            window = text[lo : lo + langid.WINDOW]
            for f, b in zip(states(window, 0), states(window[::-1], 1)[::-1]):
                e = np.exp(model.output @ np.concatenate([f, b]) + model.bias)
                total += e / e.sum()
        assert np.allclose(p, total / max(len(text), 1), atol=1e-4)


def test_backpropagation_matches_differences():
    rng = np.random.default_rng(0)
    x, mask = rng.integers(0, 5, (6, 3)), np.ones((6, 3), np.float32)
    table, rec = rng.normal(size=(256, 6)).astype("f4"), rng.normal(size=(6, 2)).astype("f4")
    states, saved = langid._forward(table, rec, x, mask, True)
    _, grad = langid._backward(rec, x, mask, saved, np.ones_like(states))
    for i, j in ((0, 0), (3, 1), (5, 0)):
        up, down = rec.copy(), rec.copy()
        up[i, j] += 1e-2
        down[i, j] -= 1e-2
        numeric = (langid._forward(table, up, x, mask).sum() - langid._forward(table, down, x, mask).sum()) / 2e-2
        assert grad[i, j] == pytest.approx(numeric, rel=0.02, abs=1e-2)


def test_hosts(spark):
    page = '<a href="http://{}/x">x</a>'
    urls = [
        (1, "http://good.example.net/en/1", page.format("mid.com")), (2, "http://mid.com/", page.format("far.org")),
        (3, "https://hub.com/a", page.format("bad.net")), (4, "http://BAD.net/x?y", None), (5, None, ""), (6, "nohost", "x"),
        (7, "http://example.com/de/1", None), (8, "http://a.org/fr/#z", None), (8, "http://a.org/fr/#z", None), (9, "http://x.net", ""),
    ]
    rules = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
    pages = prepare(spark).createDataFrame(urls, "page_id long, url string, html string")
    got = {r.page_id: r for r in hostgraph.judge_urls(pages, rules, threshold=0.3).collect()}
    assert (got[4].host, got[4].path, got[4].rule, got[4].verdict) == ("bad.net", "/x", "net/", "block")
    assert (got[1].rule, got[7].rule, got[8].rule, got[9].rule) == ("example.net/en/", "example.com/de/", "org/fr/", None)
    assert got[3].verdict == "block" and got[3].distrust == pytest.approx(0.5)  # links to a blocked host
    assert got[2].verdict == "allow" and got[2].trust == pytest.approx(0.5)  # linked from a trusted one
    assert (got[5].host, got[5].path, got[6].host, got[5].verdict) == ("", "", "", "allow")
    assert hostgraph.judge_urls(pages.limit(0), rules).count() == 0


def test_token_files(docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tool, start = Tokenizer.from_file(path), 0
    got = pfor.read_ids(pfor.write_ids(docs, path, 2, file_ids=5000)).orderBy("start").collect()
    for r, row in zip(got, sorted(rows, key=lambda r: r[0])):
        ids = [*tool.encode(row[1] or "", add_special_tokens=False).ids, 2]
        assert tuple(r) == (row[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(rows)
    assert pfor.read_ids(pfor.write_ids(empty, path, 2)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 3000])
def test_file_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 90, n).astype(np.uint32)
    ids[rng.random(n) < 0.05] = 2**32 - 1
    image = pfor.write_image(ids, [None, 7], np.array([n, 0]), 9)
    back, names, sizes, before = pfor.read_image(image)
    assert (back == ids).all() and names == [None, 7] and sizes.tolist() == [n, 0] and before == 9
    assert (pfor.read_range(image, 100, 200) == ids[100:200]).all()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_like_the_library(rows, name):
    import pyarrow as pa

    tool = PieceEncoder(public_tokenizers.path(name), slots=1 << 12)
    texts = [r[1] for r in rows] + ["don't  stop", "a.b,c!d?e", "x—y", " lead", "trail ", "ÉCOLE Straße×2÷3", "a\n b"]
    for _ in range(2):
        ids, first = tool.encode(*text_bytes(pa.array(texts)))
        for i, t in enumerate(texts):
            assert ids[first[i] : first[i + 1]].tolist() == tool.tokenizer.encode(t or "", add_special_tokens=False).ids, t


def test_one_text_beyond_the_piece_table():
    import pyarrow as pa

    tool = PieceEncoder(public_tokenizers.path("word_bpe_49k.json"), slots=1 << 10)
    texts = [" ".join(f"w{i:x}q" for i in range(5000)), "short one", " ".join(f"v{i:x}z" for i in range(900))]
    for _ in range(2):
        ids, first = tool.encode(*text_bytes(pa.array(texts)))
        for i, t in enumerate(texts):
            assert ids[first[i] : first[i + 1]].tolist() == tool.tokenizer.encode(t, add_special_tokens=False).ids
    tool.encode(*text_bytes(pa.array(["after"])))
    assert tool.n_keys < tool.slots // 2


def test_language_sample_is_bounded(spark, monkeypatch):
    """Rows that repeat an id, with one text or many, do not enlarge the sample."""
    seen = []
    monkeypatch.setattr(langid, "train", lambda windows, labels: seen.append(Counter(labels)))
    rows = [(1, f"the text {i % 50} of many", "en", "a", 1, "x") for i in range(400)] + [(2, "ein Text", "de", "a", 1, "x")] * 300
    langid.fit(prepare(spark).createDataFrame(rows, SCHEMA), F.lit(True), sample=20)
    assert seen[0]["en"] <= 20 * langid.SAMPLE_WINDOWS and 1 <= seen[0]["de"] <= 20 * langid.SAMPLE_WINDOWS


def test_lines(docs, rows, empty):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\v\f\r"))

    count = Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")})
    want = Counter()
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if not (key(x) and count[key(x)] >= 10)]
        want[r[0], r[1] and "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    cleaned = linededup.drop_common_lines(docs, 10)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in cleaned.collect()) == want
    assert cleaned.columns == [*docs.columns, "n_lines", "n_dropped"] and any(k[3] for k in want)
    assert linededup.drop_common_lines(empty).count() == 0


@pytest.mark.parametrize("buckets", [1, 8])
def test_runs_compact(spark, docs, buckets):
    runs = linededup.LineRuns(prepare(spark), fan_in=2, buckets=buckets)
    batches = [docs.where(F.pmod("doc_id", F.lit(5)) == part) for part in range(5)]
    seen = Counter()
    for batch in batches:
        keys = linededup.line_keys(batch)
        count = Counter(bytes(r._key) for r in keys.collect())
        # The batch meets all earlier runs: what they hold is old, the rest new.
        met = runs.met(keys.groupBy("_key").agg(F.count("*").alias("_docs"))).collect()
        assert {bytes(r._key): (r._docs, r._old) for r in met} == {k: (n, k in seen) for k, n in count.items()}
        runs.add(batch)
        seen += count
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = [bytes(r._key) for run in runs._runs() for r in spark.table(run.name).where("not _old").collect()]
    assert sorted(held) == sorted(seen)  # each key is new in one run only
    for least in (1, 10):
        assert {bytes(r._key) for r in runs.known(least).collect()} == {k for k, n in seen.items() if n >= least}
    again = runs.clean(docs, 1).select("text").collect()
    assert all(not (r.text or "").strip() for r in again)
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_batch_merges_with_runs_as_they_lie(spark, docs):
    runs = linededup.LineRuns(prepare(spark), fan_in=3)
    for part in range(2):
        runs.add(docs.where(F.pmod("doc_id", F.lit(2)) == part))
    counts = linededup.line_keys(docs).groupBy("_key").agg(F.count("*").alias("_docs"))
    with linededup._sorted_scans(spark):
        text = runs.met(counts)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert text.count("SortMergeJoin") == 2 and text.count("Bucketed: true") == 2
    # One sort and two exchanges, all of the batch's own counts.
    assert text.count("Sort [") == 1 and text.count("Exchange") == 2
    runs.close()


def test_many_rows_without_an_id(spark):
    rows = [(None, f"common\nown {i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = linededup.drop_common_lines(docs).collect()
    assert sorted(r.text for r in kept) == sorted(f"own {i}" for i in range(30))


def test_quality(spark, docs, rows, empty):
    labels = spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(rows[:60])] + [(9999, None)], "doc_id long, quality int")
    found = quality.judge(docs, quality.fit(docs, labels)).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found)
    want = Counter()
    for r in rows:
        text = r[1] or ""
        words, seen, again = WORD.findall(text), set(), 0
        grams, covered = Counter(zip(words, words[1:], words[2:])), set()
        for i in range(len(words) - 2):
            if grams[tuple(words[i : i + 3])] > 1:
                covered |= {i, i + 1, i + 2}
        for line in text.split("\n"):
            if WORD.search(line):
                again += line in seen
                seen.add(line)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        want[r[0], len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed] += 1
    assert got == want and not any(r.kept and r.base_failed for r in found)
    no_model = quality.fit(docs, labels.limit(0))
    assert all(r.kept != r.base_failed for r in quality.judge(docs, no_model).collect())
    assert quality.judge(empty, no_model).count() == 0


def test_quality_scores_by_brute_force(spark):
    """Scores recomputed gram by gram, with characters of one to four bytes, a null, an empty and a long text."""
    texts = ["Ab ab\tAB x", "", None, "é", "née ĐAN 漢字漢字漢 😀😀😀😀 a", "ÀÀÀÀ aaaa " * 4000, "ab", "a\u0301bc abc"]
    rng = np.random.default_rng(3)
    model = quality.Model(rng.normal(size=(len(quality.GROUPS), quality.BUCKETS)).astype(np.float32), 0.25, 1.5, -0.5)

    def bucket(values, seed):
        h = np.full(1, seed, np.uint64)
        for v in values:
            h = quality.mix(h ^ np.uint64(v))
        return int(h[0]) & (quality.BUCKETS - 1)

    def chance(text):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = [np.frombuffer(w.encode(), np.uint8) for w in re.findall(r"[^\x20\x09-\x0D]+", low)]
        hashes = np.array([quality.byte_hashes(w, np.array([0]), np.array([len(w)]))[0] for w in words], np.uint64)
        _, pairs = quality.windows(hashes, np.array([0, len(hashes)]), 2)
        z = model.bias
        for g, found in enumerate((hashes, pairs)):
            w = [float(model.weights[g][int(h) & (quality.BUCKETS - 1)]) for h in found]
            z += sum(w) / max(len(w), 1)
        for g, n in ((2, 3), (3, 4)):
            w = [float(model.weights[g][bucket((int.from_bytes(c.encode(), "little") for c in low[i : i + n]), n)]) for i in range(len(low) - n + 1)]
            z += sum(w) / max(len(w), 1)
        return 1 / (1 + math.exp(-(1.5 * z - 0.5)))

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality.judge(docs, model).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert abs(got[i] - chance(text)) < 1e-6, text


def test_quality_sample_is_bounded(spark, monkeypatch):
    """One id on many rows with many labels: the driver gets the sample, no more; repeats change nothing."""
    seen = []
    train = quality.train
    monkeypatch.setattr(quality, "train", lambda y, *a: seen.append(len(y)) or train(y, *a))
    docs = spark.createDataFrame([(7, f"text number {i} of one id") for i in range(300)] + [(i, f"other {i}") for i in range(20, 60)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1)] * 50 + [(i, i % 2) for i in range(20, 60)], "doc_id long, quality int")
    quality.fit(docs, labels, rows=20)
    assert seen.pop() <= 20
    plain = docs.where("doc_id <> 7")
    one = quality.fit(plain, labels.where("doc_id <> 7"), rows=20)
    two = quality.fit(plain.union(plain), labels.where("doc_id <> 7"), rows=20)
    assert seen == [20, 20] and np.array_equal(one.weights, two.weights)


def test_quality_verdicts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality.judge(docs, quality.fit(docs, labels)).join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r.kept == (r.quality == 1) for r in found) >= 0.97 * len(found)


@pytest.mark.parametrize("targets", [None, {"a": 0.2, "b": 0.8}])
def test_packing(docs, rows, empty, targets):
    path = public_tokenizers.path("word_bpe_49k.json")
    tool = Tokenizer.from_file(path)
    pieces = packing.pack(docs, path, 1, targets, sequence=256, window=1024).collect()
    ids = {r[0]: np.array([*tool.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4") for r in rows}
    copies, sequences, got = Counter(r[0] for r in rows), {}, Counter()
    for p in pieces:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert (p.doc_tokens, p.ids_crc32) == (len(ids[p.doc_id]), zlib.crc32(part.tobytes()))
        got[p.doc_id] += p.length
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert got == {d: len(v) * copies[d] for d, v in ids.items()}
    for number, parts in sequences.items():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end == 256 or number == max(sequences)
    assert packing.pack(empty, path, 1).count() == 0


def test_windows_keep_proportions():
    layout = packing.Layout([5000, 3000, 17], None, window=100)
    place = np.zeros(8017, np.int64)
    for k, n in enumerate([5000, 3000, 17]):
        for _, at, size in layout.runs(k, 0, n):
            place[at : at + size] += k + 1
    assert set(place) == {1, 2, 3}
    for w in range(0, 7900, 100):
        assert abs((place[w : w + 100] == 1).sum() - 62.4) <= 3


@pytest.mark.parametrize("totals", [[500_000, 250_000, 9_990, 7, 333_333], [70_000] * 60 + [1, 3, 0], [5]])
@pytest.mark.parametrize("targets", [False, True])
def test_every_sequence_keeps_proportions(totals, targets):
    """With the production window, in each full sequence of a phase."""
    size = packing.SEQUENCE_TOKENS
    layout = packing.Layout(totals, [1.0 + k % 3 for k in range(len(totals))] if targets else None)
    place = np.full(sum(totals), -1)
    for k, n in enumerate(totals):
        for a in range(0, n, 777):
            for _, at, length in layout.runs(k, a, min(a + 777, n)):
                assert (place[at : at + length] == -1).all()
                place[at : at + length] = k
    assert (place >= 0).all()
    for _, take, at in layout.phases:
        share = np.array(take) / sum(take)
        for s in range(-(-at // size) * size, at + sum(take) - size + 1, size):
            got = np.bincount(place[s : s + size], minlength=len(totals))
            assert (abs(got - share * size) <= 2 + len(totals) * share).all()


def _components(rows):
    sets = {}
    for doc, text, *_ in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize("options", [None, (0.0,), (1 / 4,), (1.0,), (jaccard.SUBSETS, 0.5)])
def test_jaccard(docs, rows, empty, options):
    want = _components(rows)
    got = jaccard.components_table(docs, options=options).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert jaccard.components_table(empty).count() == 0


def test_rows_of_one_id_are_one_node(spark):
    x, y, z = (" ".join(f"{c}{i}" for i in range(30)) for c in "xyz")
    rows = [(1, x), (1, y), (5, x), (0, y), (7, z), (7, None), (9, z), (6, ""), (6, z), (None, x), (None, "lone words here"), (8, None)]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.components_table(docs).collect())
    assert got == Counter([
        (1, 26, 0), (1, 26, 0), (5, 26, 0), (0, 26, 0), (7, 26, 6), (7, 0, 6), (9, 26, 6), (6, 0, 6), (6, 26, 6),
        (None, 26, 0), (None, 1, None), (8, 0, 8),
    ])
    # The filter looks at texts: one row of each stays, unlike texts of one id too.
    kept = Counter(r.text for r in jaccard.keep_one(docs).collect())
    assert kept == Counter({x: 1, y: 1, z: 1, None: 2, "": 1, "lone words here": 1})


def test_cost_codes_keep_the_order():
    cost = np.unique(np.concatenate([np.arange(10000), np.random.default_rng(3).integers(0, 1 << 42, 100000), [(1 << 42) - 1]]))
    code = jaccard.cost_code(cost)
    assert (np.diff(code) >= 0).all() and code.min() == 0 and code.max() == 65535
    assert (jaccard.code_cost(code) <= cost).all() and (cost - jaccard.code_cost(code) <= cost >> 11).all()
    assert (jaccard.code_cost(code)[cost < 4096] == cost[cost < 4096]).all()
    # Counts of a corpus of some 30 GB: a passage of a thousand documents stands out in a bucket of singles.
    assert jaccard.cost_code(np.array([77000])) > jaccard.cost_code(np.array([76000]))


def test_links_beyond_a_repeated_hub(spark):
    """A, B and C meet in one shingle only; A is like neither, B and C are alike, and A is the hub of rounds 0 and 1."""

    def texts(salt):
        w, x = ([f"{c}{salt}n{i}" for i in range(11)] for c in "wx")
        b = w[1:10]
        own = [" ".join(f"own{salt}n{f}n{i}" for i in range(50)) for f in range(4)]
        # The long ones make all but the shared shingle common, so that it leads in A, B and C.
        return [" ".join(t) for t in (x[1:5] + w[1:6], b, b + w[10:])] + [" ".join([o, *x[1:5], *w[1:5], o[::-1], *w[2:11]]) for o in own]

    def classes(salt):
        parts = [t.encode() for t in texts(salt)[:3]]
        offsets = np.cumsum([0, *map(len, parts)])
        return jaccard.class_ids(*jaccard.shingle_sets(np.frombuffer(b"".join(parts), np.uint8), offsets)).tolist()

    table = spark.createDataFrame([(s, k, c) for s in range(60) for k, c in enumerate(classes(s))], "salt int, k int, cls long")
    hubs = table.groupBy("salt").agg(F.min_by("k", "cls").alias("first"), F.min_by("k", F.xxhash64("cls", F.lit(1))).alias("next"))
    salt = hubs.where("first = 0 and next = 0").agg(F.min("salt")).first()[0]
    got = jaccard.components_table(prepare(spark).createDataFrame(list(enumerate(texts(salt))), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {0: 0, 1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6}


def test_one_of_each_group_stays(docs, rows):
    want = _components(rows)
    kept = jaccard.keep_one(docs)
    ids = Counter(r.doc_id for r in kept.collect())
    assert kept.columns == docs.columns
    assert ids == Counter(d for d, (n, c) in want.items() if not n or d == c)


def test_repeats(docs, rows, empty):
    seen, want = set(), Counter()
    results = {}
    for doc, text, *_ in sorted(set(rows), key=lambda r: r[0]):
        words, gone = WORD.findall(text or ""), set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        results[doc] = (text and " ".join(w for i, w in enumerate(words) if i not in gone), len(words), len(gone))
    for doc, *_ in rows:
        want[doc, *results[doc]] += 1
    got = Counter((r.doc_id, r.text, r.n_words, r.n_removed) for r in repeats.drop_repeats(docs).collect())
    assert got == want and any(k[3] for k in want)
    assert repeats.drop_repeats(empty).count() == 0

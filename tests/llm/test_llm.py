"""The training-data operators against plain versions, round trips and held-out labels, with nulls, empties and odd columns."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path
import sys

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute
import brute_lm

from gristmill.llm import ann, bpe, classifier, lm, packing, pii, queries, rules, simhash, store, toxicity, units

SMALL = "/root/testdata/sf0.001"
RANKS, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
BASE = "the cat sat on a mat and saw seven grey birds fly over the old stone house near a river " * 4
ODD = [None, "", " ", "one", "a b", BASE, BASE, BASE + "extra", "x" * 5000, "Ünï 漢字 😀 ́ tail\n\n tail\t\ttail  end ", "<|endoftext|> a <|endoftext|>", "word " * 3000]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a null id, a repeated row, and extra columns named like outputs and inner columns."""
    rows = [(i, t, "x", 1.0) for i, t in enumerate(ODD)] + [(None, BASE, None, None), (3, "one", "x", 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, __words double").withColumn("fingerprint", F.lit(0))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_registered():
    assert {q.split("_")[0] for q in queries.queries()} == {f"op{n}" for n in range(1, 11)} | {"pipeline"}


def test_simhash(spark, docs, odd):
    for df, key in ((docs, "doc_id"), (odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), "doc_id")):
        want = brute.near_duplicates([(r["doc_id"], r["text"]) for r in df.collect()])
        assert {r[key]: (r["fingerprint"], r["component_id"]) for r in rows(simhash.near_duplicates(df))} == want
    got = rows(simhash.near_duplicates(odd))
    assert len(got) == len(ODD) + 2 and next(r for r in got if r["doc_id"] is None)["component_id"] == 5
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [64, 1])
def test_simhash_links_are_whole(spark, limit):
    """Both ways of linking, pairs and midpoints, on crowded fingerprints."""
    rng = random.Random(5)
    fps = {0}
    for centre in [rng.getrandbits(64) for _ in range(6)]:
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(40)}
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    got = brute.components([simhash._signed(f) for f in fps], [(r["src"], r["dst"]) for r in rows(simhash.links(df, limit))])
    pairs = [(simhash._signed(a), simhash._signed(b)) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 2]
    assert got == brute.components([simhash._signed(f) for f in fps], pairs)


def test_dedup_keeps_one_of_each_group(spark, odd):
    kept = rows(simhash.deduplicated(odd))
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted({c for i, (_, c) in brute.near_duplicates(list(enumerate(ODD))).items()})
    assert sum(r["doc_id"] is None for r in kept) == 1 and set(kept[0]) == set(odd.columns)


def test_rules(spark, docs, odd, labels):
    for df in (docs, odd):
        texts = {(r["doc_id"], r["text"]) for r in df.collect()}
        want = Counter((i, *brute.rule_counts(t)) for i, t in ((r["doc_id"], r["text"]) for r in df.collect()))
        got = rows(rules.quality_rules(df, labels))
        assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want and texts
        for r in got:
            assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
            assert r["kept"] == (not r["base_failed"] and (r["llr"] is None or r["llr"] >= rules.THRESHOLD))
    assert rules.quality_rules(odd.limit(0), labels).count() == 0
    assert rules.quality_rules(odd, labels.limit(0)).filter("llr <> 0").count() == 0
    stays = rules.passing(odd, labels)
    assert stays.columns == odd.columns and stays.count() == rules.quality_rules(odd, labels).filter("kept").count()


def test_log_ratio(spark, docs, labels):
    """The ratio from plain sums over buckets that Spark hashed."""
    grams = rules._words(docs, F.col("text")).select("doc_id", rules._buckets("__words").alias("b")).collect()
    good = {r["id"] for r in rules.trusted_ids(labels).collect()}
    raw, target = Counter(), Counter()
    for r in grams:
        raw.update(r["b"])
        target.update(r["b"] if r["doc_id"] in good else [])
    n, t, k = sum(raw.values()), sum(target.values()), rules.BUCKETS
    w = [math.log((target[b] + 1) / (t + k) / ((raw[b] + 1) / (n + k))) for b in range(k)]
    want = {r["doc_id"]: sum(w[b] for b in r["b"]) / len(r["b"]) for r in grams if r["b"]}
    got = {r["doc_id"]: r["llr"] for r in rows(rules.quality_rules(docs, labels)) if r["llr"] is not None}
    assert got == pytest.approx(want, abs=1e-5)


def test_buckets_of_a_word_are_the_same_everywhere(spark):
    df = spark.createDataFrame([(["a", "b", "a", "b", "a"],)], "w array<string>")
    r = df.select(rules._buckets("w").alias("b"), F.xxhash64(F.lit("a")).alias("a"), F.xxhash64(F.lit("b"), F.lit("a")).alias("ba")).first()
    assert [r["b"][k] for k in (0, 2, 4)] == [(r["a"] + 1) % rules.BUCKETS] * 3 and [r["b"][k] for k in (6, 8)] == [(r["ba"] + 2) % rules.BUCKETS] * 2


def test_rules_reject_low_quality_texts_that_are_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 1
    bad = {r["doc_id"] for r in labels.filter(held & (F.col("quality") == 0)).collect()}
    judged = [r for r in rows(rules.quality_rules(docs.repartition(4), labels.filter(~held))) if r["doc_id"] in bad and not r["base_failed"]]
    assert judged and sum(not r["kept"] for r in judged) >= 0.9 * len(judged)


def test_rules_stay_in_the_engine(docs, labels):
    plan = rules.quality_rules(docs, labels)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_classifier(spark, odd, labels):
    d = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in rows(queries.op2_quality_classifier(spark, d))}
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    held = [i for i, r in got.items() if r["held_out"] and i in truth]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for i, r in got.items())
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) > 0.95
    few = rows(classifier.quality_scores(odd, labels.limit(0)))
    assert len(few) == len(ODD) + 2 and {r["score"] for r in few} == {0.5}
    assert classifier.quality_scores(odd.limit(0), labels).count() == 0
    assert classifier.accepted(odd, labels.limit(0)).count() == len(ODD) + 2


def test_all_words_count_for_capitals():
    text = b"AB cd " * 1024
    assert classifier.statistics(text)[classifier.STATS.index("inner_case")] == 0.5


def test_isotonic():
    x, y = classifier.isotonic(np.arange(5.0), np.array([0, 1, 0, 1, 1.0]), np.ones(5))
    assert y.tolist() == [0, 0.5, 1, 1] or y.tolist() == [0, 0.5, 1]
    assert (np.diff(x) > 0).all()


def test_toxicity(spark, odd, labels):
    d = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in rows(queries.op6_toxicity(spark, d))}
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    held = [i for i, r in got.items() if r["held_out"] and i in truth]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) > 0.9
    assert {r["score"] for r in rows(toxicity.toxicity(odd, labels.limit(0)))} == {0.5}
    assert toxicity.toxicity(odd.limit(0), labels).count() == 0


def test_toxic_words_in_disguise():
    lex = toxicity.Lexicon({" stupid ": 3.0, " idiot ": 3.0, " clown ": 2.0})
    auto = lex.matcher()
    for t, n in (("You STUP1D idi0t!", 2), ("ѕtuріd", 1), ("stupidity", 0), ("a clown fish", 0), ("clown fish clown", 1), ("ｓｔｕｐｉｄ", 1), ("", 0)):
        assert (lex.total(t, auto)[0] > 0) == (n > 0), t
    assert lex.total("clown fish clown", auto)[0] == 2.0


KIND = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(t):
    out = []
    for kind, p in KIND.items():
        for m in re.finditer(p, t):
            d = re.sub(r"[^0-9]", "", m[0])
            fine = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 14 <= len(d) <= 19 and pii.luhn(d), "phone": 10 <= len(d) <= 15}
            if fine[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out, key=lambda s: (s[0], list(KIND).index(s[1])))


def test_pii_base_spans_are_the_patterns(docs):
    rng = random.Random(2)
    texts = [r["text"] for r in docs.collect()]
    texts += ["".join(rng.choice("ab1.@ -+()255é\n") for _ in range(60)) for _ in range(4000)] + ["a@b@c.d e@f..g 1.2.3.4.5 4111 1111 1111 1111 +1 (555) 010-9999 999.1.1.1"]
    for t in texts:
        assert pii.base_spans(t) == plain_spans(t), t


def test_pii_query(docs, odd):
    for df in (docs, odd):
        for r in rows(pii.personal_data(df)):
            t = next(x["text"] or "" for x in df.collect() if x["doc_id"] == r["doc_id"])
            base = plain_spans(t)
            assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(k == s[1] for s in base) for k in pii.KINDS]
            assert r["base_sha256"] == hashlib.sha256(pii.listed(base).encode()).hexdigest()
            assert set(pii.listed(base).split(",")) <= set(r["spans"].split(","))
    assert pii.personal_data(odd.limit(0)).count() == 0


def test_pii_added_spans_and_redaction():
    trees = pii.selector()
    got = lambda t: [t[a:b] for a, _, b in pii.all_spans(t, trees)]
    assert got("write to jane.roe (at) example (dot) org today") == ["jane.roe (at) example (dot) org"]
    assert got("host 10[.]0[.]0[.]7 is up") == ["10[.]0[.]0[.]7"]
    for clean in ("he was at home dot matrix", "born 2020-01-02 in May", "costs 1,234.56 or 12 % more", ""):
        assert got(clean) == []
    rows_ = pii.examples()
    assert len(rows_) <= pii.EXAMPLES and np.mean([g for *_, g in rows_]) > 0.2
    t = "a x@y.zz b +1 555 010 9999"
    assert pii.redacted(t, pii.base_spans(t)) == "a [EMAIL] b [PHONE]"
    long = "a" * 200_000 + " " + "1" * 200_000 + " " + "+1" + "(" * 100_000
    assert pii.base_spans(long) == []


def test_spans_that_are_covered():
    rng = random.Random(4)
    for _ in range(300):
        covered, spans = pii.Covered(), []
        for _ in range(rng.randint(1, 12)):
            a = rng.randint(0, 40)
            b = a + rng.randint(1, 9)
            assert covered.meets(a, b) == any(a < y and x < b for x, y in spans)
            covered.add(a, b)
            spans.append((a, b))


@pytest.mark.parametrize("what", ["a@b.cc 10[.]0[.]0[.]7 call 555-010-9999 now ", "trash can idiot clown fish "])
def test_many_spans_take_time_in_proportion(what):
    lex = toxicity.Lexicon({" idiot ": 3.0, " clown ": 2.0})
    auto, trees = lex.matcher(), pii.selector()
    seconds = []
    for n in (400, 3200):
        start = time.perf_counter()
        pii.all_spans(what * n, trees)
        assert lex.total(what * n, auto)[0] == 3.0 * n * ("idiot" in what)
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 25 * seconds[0] + 0.5


def test_added_spans_are_found_in_documents(docs):
    """Personal data in other spellings, put between the sentences of documents: most is found, and little else."""
    rng, trees = random.Random(6), pii.selector()
    texts = [r["text"] for r in docs.collect() if r["text"]][:150]
    made = [(t, s) for t, s, good in pii.examples(seed=99) if good][: len(texts)]
    found = extra = 0
    for t, (context, (a, kind, b)) in zip(texts, made):
        words = t.split(" ")
        k = rng.randrange(len(words))
        before = " ".join(words[:k])
        whole = f"{before} {context} {' '.join(words[k:])}"
        at = len(before) + 1
        new = set(pii.all_spans(whole, trees)) - set(pii.base_spans(whole))
        found += any(x < at + b and at + a < y for x, _, y in {*new, *pii.base_spans(whole)})
        extra += sum(not (x < at + len(context) and at < y) for x, _, y in new)
    assert found >= 0.9 * len(texts) and extra <= 0.05 * len(texts)


def test_toxicity_is_the_plain_sum(docs, labels):
    """Scores against a search for every term and phrase, one after another."""
    lex = toxicity.fit(docs, labels)
    auto = lex.matcher()
    for t in [r["text"] or "" for r in docs.collect()][:120] + ["You trash can, idi0t! clown fish clown"]:
        f = toxicity.folded(t)
        spared = [(m.start(), m.start() + len(x) + 1) for x in lex.exceptions for m in re.finditer(f"(?= {x} )", f)]
        best: dict = {}
        for term, w in lex.weights.items():
            for m in re.finditer(f"(?={re.escape(term)})", f):
                if not any(a <= m.start() < b for a, b in spared):
                    best[m.start()] = max(w, best.get(m.start(), w))
        assert lex.total(t, auto)[0] == pytest.approx(sum(best.values()))


def test_ridge_and_scores_are_the_plain_ones(spark):
    """Summed equations against least squares over all rows at once, and calibrated scores against plain ones."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, len(classifier.STATS)))
    y = (x[:, 0] + 0.3 * rng.normal(size=300) > 0).astype(int)
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, y))], "doc_id long, stats array<double>, y int").repartition(5)
    model = classifier.fit(df)
    z = classifier.Model(x.mean(0), x.std(0), model.weights, model.knots, model.heights).features(x)
    damp = classifier.RIDGE * np.eye(z.shape[1])
    damp[-1, -1] = 0
    assert model.weights[0] == pytest.approx(np.linalg.solve(z.T @ z + damp + 1e-9 * np.eye(len(damp)), z.T @ y), rel=1e-5, abs=1e-7)
    assert model.score(x) == pytest.approx(np.clip(np.interp(z @ model.weights[0], model.knots, model.heights), 0, 1), abs=1e-6)
    assert (np.diff(model.heights) >= 0).all() and np.mean((model.score(x) > 0.5) == y) > 0.9


def test_dedup_of_a_repeated_id_is_determined(spark):
    data = [(1, "b " * 60, 2), (1, "b " * 60, 1), (1, "a " * 60, 9), (2, "a " * 60, 3)]
    for part in (1, 3):
        got = rows(simhash.deduplicated(spark.createDataFrame(data, "doc_id long, text string, n int").repartition(part)))
        assert [(r["doc_id"], r["text"][0], r["n"]) for r in got] == [(1, "a", 9)]


def test_bpe_is_tiktokens(docs, odd):
    ranks = bpe.load(RANKS).ranks
    tok = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df in (docs, odd):
        want = Counter()
        for r in df.collect():
            ids = tok.encode_ordinary(r["text"] or "")
            want[r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
        assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows(bpe.digests(df, RANKS, P.PATTERN))) == want
    assert bpe.digests(odd.limit(0), RANKS, P.PATTERN).count() == 0


def test_prefix_tables_append_and_edit():
    b, rng = bpe.load(RANKS), random.Random(4)
    for _ in range(60):
        data = "".join(rng.choice("abcdehinorst é") for _ in range(rng.randint(1, 300))).encode()
        table = bpe.Prefixes(b, data[:7])
        table.append(data[7:])
        assert table.last == bpe.Prefixes(b, data).last and b.decode(table.ids()) == data
        i = rng.randrange(len(data) + 1)
        j = min(len(data), i + rng.randint(0, 9))
        new = bytes(rng.choice(b"abc th") for _ in range(rng.randint(0, 9)))
        table.replace(i, j, new)
        assert table.last == bpe.Prefixes(b, data[:i] + new + data[j:]).last
    big = bpe.Prefixes(b, b"international house " * 200)
    assert big.replace(100, 103, b"zz") < 200


def test_units_are_the_whole_text():
    tok, enc, rng = Tokenizer.from_file(JSON), store.Encoder(JSON), random.Random(6)
    texts = ["".join(rng.choice("abc  \n\t'sé漢.,!1\x85\xa0\x1c") for _ in range(rng.randint(0, 50))) for _ in range(3000)] + [t or "" for t in ODD] + ["ab cd " * 300_000 + "e"]
    for t, ids in zip(texts, enc.texts(texts)):
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids
    assert sum(map(len, units._windows(b"ab " * 900_000))) < 2_700_000


def test_units_whose_hashes_would_collide():
    """Thue-Morse words and their complements agree under every polynomial hash modulo 2**64; tables are emptied on the way."""
    ranks = bpe.load(RANKS).ranks
    tik, tok = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), Tokenizer.from_file(JSON)
    texts = []
    for n in (512, 1024, 2048, 4096):
        word = "".join("ab"[i.bit_count() & 1] for i in range(n))
        other = word.translate(str.maketrans("ab", "ba"))
        texts += [f"x {word} {other}", word, other, f"{other} {word} {word}"]
    rng = random.Random(8)
    texts += [" ".join("".join(rng.choice("abé漢à") for _ in range(rng.randint(1, 30))) for _ in range(60)) for _ in range(300)]
    one, two = store.Encoder(JSON), bpe.Encoder(RANKS, P.PATTERN)
    for k in range(3):
        for t, a, b in zip(texts, one.texts(texts), two.texts(texts)):
            assert a.tolist() == tok.encode(t, add_special_tokens=False).ids and b.tolist() == tik.encode_ordinary(t)
        one.texts.used = two.texts.kept = 1 << 40  # both are emptied at the next text


def test_texts_that_do_not_split_are_suspect():
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab  \n\t\x85\xa0\u2003\u3000àé“") for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    found = set(units.suspects([t.encode() for t in texts]))
    assert {k for k, t in enumerate(texts) if not units.splits(t)} <= found and units.suspects([b"a b", "à la".encode()]) == []


def test_every_code_point_is_of_tiktokens_class():
    """Letter, number or white space, other: as the pieces that tiktoken makes of each code point show."""
    ranks = {bytes([b]): b for b in range(256)} | {b"'s": 256} | {b"a" + bytes([b]): b + 257 for b in range(0xC2, 0xF5)}
    ask = tiktoken.Encoding("probe", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    split, odd = bpe.Encoder(RANKS, P.PATTERN).split, []
    for k in (*range(128, 0xD800), *range(0xE000, 0x110000)):
        c = chr(k)
        pieces = split(f"a{c} {c}'s")
        if (ask("a" + c)[0] > 256) != (pieces[0] == "a" + c) or (ask(c + "'s")[-1] == 256) != (pieces[-1] == "'s"):
            odd.append(c)
    assert odd == []


def test_store(spark, docs, odd, tmp_path):
    tok = Tokenizer.from_file(JSON)
    for k, df in enumerate((docs, odd)):
        folder = f"{tmp_path}/s{k}"
        store.write(df, JSON, folder)
        got = sorted(rows(store.digests(spark, folder)), key=lambda r: r["start"])
        assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got]).tolist()[:-1]
        ids = [r["doc_id"] for r in got]
        assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
        want = Counter((r["doc_id"], tuple(tok.encode(r["text"] or "", add_special_tokens=False).ids + [0])) for r in df.collect())
        assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows(store.reconstruct(spark, folder))) == want
        assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter({(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())): n for (i, x), n in want.items()})
        keys = [bytes(r["key"]) for r in store._data(spark, folder).filter("key IS NOT NULL").collect()]
        assert len(keys) == len(set(keys))
    empty = f"{tmp_path}/e"
    store.write(odd.limit(0), JSON, empty)
    assert store.digests(spark, empty).count() == 0


def test_store_notices_damage(spark, docs, tmp_path):
    store.write(docs.limit(20), JSON, f"{tmp_path}/a")
    raw = spark.read.parquet(f"{tmp_path}/a/chunks")
    for p in ("recipes", "manifest"):
        spark.read.parquet(f"{tmp_path}/a/{p}").write.parquet(f"{tmp_path}/b/{p}")
    raw.withColumn("data", F.when(F.col("key").isNotNull(), F.concat(F.col("data"), F.lit(b"\0\0")))).write.parquet(f"{tmp_path}/b/chunks")
    with pytest.raises(Exception, match="doesn't fit its key"):
        store.digests(spark, f"{tmp_path}/b").collect()


def test_crc_join():
    rng = random.Random(1)
    for _ in range(50):
        a, b = rng.randbytes(rng.randint(0, 50)), rng.randbytes(rng.randint(0, 5000))
        assert store.crc_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_packing(spark, docs, odd):
    for df in (docs, odd):
        counts = store.token_counts(df, JSON)
        sizes = Counter((r["doc_id"], r["n_tokens"]) for r in rows(counts))
        got = rows(packing.packed(counts, shard=20_000))
        assert sum(r["n_tokens"] for r in got) == sum(k[1] * n for k, n in sizes.items())
        bins = {}
        for r in got:
            bins.setdefault((r["shard"], r["bin"]), []).append(r)
        for parts in bins.values():
            spans = sorted((r["position"], r["position"] + r["n_tokens"]) for r in parts)
            assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
            assert {r["bin_length"] for r in parts} == {min(c for c in packing.LENGTHS if c >= spans[-1][1])}
    none = rows(packing.packed(spark.createDataFrame([(1, 0, 0), (2, None, 0)], "doc_id long, n_tokens long, fold long")))
    assert {r["bin"] for r in none} == {None} and len(none) == 2
    assert packing.packed(store.token_counts(odd.limit(0), JSON)).count() == 0
    rng = random.Random(3)
    many = sorted((min(8192, int(rng.lognormvariate(6, 1)) + 1) for _ in range(2000)), reverse=True)
    _, _, caps = packing.pack(many)
    assert sum(many) / sum(caps) > 0.98


def test_packing_of_few_pieces_is_near_the_best():
    """Against every way of dealing pieces to bins; and no single length is opened for all."""
    rng, ratios = random.Random(3), []

    def best(sizes, bins=()):
        if not sizes:
            return sum(packing.cost(min(c for c in packing.LENGTHS if c >= u)) for u in bins)
        ways = [bins[:k] + (u + sizes[0],) + bins[k + 1 :] for k, u in enumerate(bins) if u + sizes[0] <= max(packing.LENGTHS)]
        return min(best(sizes[1:], w) for w in (*ways, (*bins, sizes[0])))

    for _ in range(150):
        sizes = sorted((min(8192, int(rng.lognormvariate(6.5, 1.2)) + 1) for _ in range(rng.randint(1, 7))), reverse=True)
        ratios.append(sum(map(packing.cost, packing.pack(sizes)[2])) / best(tuple(sizes)))
    assert max(ratios) < 1.3 and np.mean(ratios) < 1.01
    many = sorted((min(8192, int(rng.lognormvariate(6.5, 1.2)) + 1) for _ in range(3000)), reverse=True)
    used = Counter(packing.pack(many)[2])
    assert all(used[c] > 20 for c in (1024, 2048, 4096, 8192))


def test_equal_rows_spread_over_shards(spark):
    same = spark.createDataFrame([(1, 100, 7)] * 400, "doc_id long, n_tokens long, fold long")
    got = rows(packing.packed(same, shard=4000))
    assert len(got) == 400 and len({r["shard"] for r in got}) > 5


def exact(x, ids, every, k):
    out = {}
    for q in sorted({i for i in ids if i % every == 0}):
        far = np.sqrt(((x - x[list(ids).index(q)]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, far)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), far[j]) for j in order]
    return out


def test_nearest(spark):
    e = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    got = {}
    for r in sorted(rows(ann.nearest(e, every=20)), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    d = e.toPandas()
    assert got == exact(np.vstack(d.embedding.to_list()).astype(float), d.vec_id.to_numpy(), 20, 10)


def test_nearest_recall_with_defaults(spark):
    """2000 vectors are four times what every query sees at least, so the index decides."""
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    d = e.toPandas()
    assert len(d) > 3 * ann.ENOUGH
    want, got = exact(np.vstack(d.embedding.to_list()).astype(float), d.vec_id.to_numpy(), 100, 10), rows(ann.nearest(e))
    assert len(got) == 10 * len(want) and np.mean([(r["vec_id"], r["score"]) in want[r["query_id"]] for r in got]) >= 0.9


def test_nearest_recall_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(size=(2000, 8)), np.tile(rng.normal(size=8), (1000, 1))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    bad = [(3000, None), (3100, [0.0] * 8), (3200, [float("nan")] * 8), (3300, [1.0, None] + [1.0] * 6), (3400, []), (3500, [float("inf")] * 8), (3600, [1.0] * 5), (None, [1.0] * 8)]
    mixed = df.unionByName(spark.createDataFrame(bad, df.schema)).withColumn("label", F.lit(1)).withColumn("first", F.lit("x"))
    got = rows(ann.nearest(mixed, enough=300, share=0.3, group=200))
    want = exact(x, np.arange(len(x)), 100, 10)
    assert {r["query_id"] for r in got} == set(want) and len(got) == 10 * len(want)
    assert sum((r["vec_id"], r["score"]) in want[r["query_id"]] for r in got) / len(got) >= 0.9
    assert ann.nearest(mixed.limit(0)).count() == 0
    assert len(rows(ann.nearest(df.limit(3), every=2))) == 4


def test_language_model(spark, docs, odd):
    for df in (docs, odd):
        data = [(r["doc_id"], brute.words(brute.ascii_lower(r["text"])) + ["\n"]) for r in df.collect()]
        learns = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 != 1
        c = Counter(w for i, ws in data if learns(i) for w in ws)
        n, v = sum(c.values()), len(c)
        want = sorted((str(i), not learns(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 5)) for i, ws in data)
        for head in (lm.HEAD, 50):
            got = rows(lm.scores(df, head=head))
            assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got) == want
            assert all(r["score"] < 0 for r in got)
    assert lm.scores(odd.limit(0)).count() == 0


def test_language_model_score_is_the_plain_models(spark, docs, odd):
    """The score against one decision after another in plain Python, with counts in dictionaries."""
    for df, head in ((docs.filter("doc_id < 40"), lm.HEAD), (docs.filter("doc_id < 25"), 60), (odd, lm.HEAD)):
        data = [(r["doc_id"], (r["text"] or "").encode()) for r in df.collect()]
        want = brute_lm.scores(data, head)
        got = sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in rows(lm.scores(df, head=head)))
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=2e-4, abs=1e-3)


def test_language_model_sums_to_one():
    """Over all one-word texts of a closed code the probabilities of class paths and shares sum to one."""
    v = lm.Vocabulary([b"a", b"b", b"c"], np.array([5, 3, 2]), 14, 4, 4).ready()
    rng = np.random.default_rng(2)
    m = lm.Mixer(lm.WORDS, rng.integers(0, 9, lm.WORDS.size))
    symbols, zero = np.arange(256), np.zeros(256, np.int64)
    each = m.log_prob(symbols, [zero] * 3, symbols, zero, 256)
    assert np.exp(each).sum() == pytest.approx(1, abs=1e-3)
    for k in set(v.classes.tolist()):
        assert np.exp(v.share[v.classes == k]).sum() == pytest.approx(1)


def test_language_model_adapts_within_short_texts():
    """The same word 64 times: the weights move, so later ones are likelier than at the start weights."""
    counts = np.ones(lm.WORDS.size, np.uint32)
    counts[255::256] = 300
    zero, n = np.zeros(64, np.int64), 64
    m = lm.Mixer(lm.WORDS, counts)
    symbols = np.full(n, 255)
    moved = m.log_prob(symbols, [zero] * 3, zero, np.arange(n), 1).sum()
    fixed = m.log_prob(symbols, [zero] * 3, np.arange(n), zero, n).sum()
    assert moved > fixed + 1e-3
    assert lm.WORDS.blocks(np.array([0, 15, 16, 32, 64, 127, 128, 255, 256])).tolist() == [0, 0, 1, 2, 3, 3, 4, 4, 5]


def test_counts_of_decisions_follow_from_those_of_symbols():
    symbols = np.random.default_rng(3).integers(0, 5, 512)
    zero, one = lm.decided(symbols)
    for room in (0, 1):
        for node in (1, 2, 3, 77, 255):
            level = node.bit_length() - 1
            below = [[symbols[room * 256 + x] for x in range(256) if 1 << level | x >> (8 - level) == node and x >> (7 - level) & 1 == bit] for bit in (0, 1)]
            assert (zero[room * 256 + node], one[room * 256 + node]) == (sum(below[0]), sum(below[1]))


def test_words_of_the_language_model():
    rng = random.Random(3)
    some = ["".join(rng.choice("aB \n\t\v\f\ré\xa0\x1cxyz") for _ in range(rng.randint(0, 90))).encode() for _ in range(200)] + [b"", b"z" * 40, b" "]
    words = lm.Words(some)
    plain = [brute.words(brute.ascii_lower(t.decode())) for t in some]
    assert [w.decode() for w in words.bytes(np.arange(len(words.starts)))] == [w for ws in plain for w in ws] and words.tokens.tolist() == [len(w) + 1 for w in plain]
    head = sorted({w.encode() for ws in plain for w in ws})[::2]
    v = lm.Vocabulary(head, np.arange(len(head)) + 2, 10_000, 500, 9).ready()
    place = {w: k for k, w in enumerate(head)}
    assert v.find(words).tolist() == [place.get(w.encode(), len(head) + 1) for ws in plain for w in ws]


def test_a_repeated_document_is_likely(spark):
    """A held-out copy of a training document costs a fraction of the bits of a text that occurs once."""
    rng = random.Random(5)
    text = lambda: " ".join("".join(rng.choice(("ka", "lo", "mi", "tu", "re")) for _ in range(rng.randint(1, 5))) for _ in range(400))
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    data = [(i, text()) for i in range(60)]
    data[held[0]] = (held[0], data[next(i for i in range(60) if i not in held)][1])
    bits = {r["doc_id"]: r["bits_per_byte"] for r in rows(lm.scores(spark.createDataFrame(data, "doc_id long, text string")))}
    assert bits[held[0]] < 0.3 * min(bits[i] for i in held[1:])


def test_pipeline(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    one = c.quality_classifier(spark, docs, SMALL).cache()
    scores = {r["doc_id"]: r["predicted"] for r in rows(classifier.quality_scores(docs, labels))}
    assert {r["doc_id"] for r in rows(one)} == {i for i, p in scores.items() if p} and one.columns == docs.columns
    two = c.quality_rules(spark, one, SMALL).cache()
    assert {r["doc_id"] for r in rows(two)} == {r["doc_id"] for r in rows(rules.quality_rules(one, labels)) if r["kept"]}
    three = c.near_dedup(spark, two, SMALL).cache()
    want = brute.near_duplicates([(r["doc_id"], r["text"]) for r in rows(two)])
    assert {r["doc_id"] for r in rows(three)} == {x[1] for x in want.values()} and three.columns == docs.columns
    four = c.pii_redaction(spark, three, SMALL).cache()
    before = {r["doc_id"]: r["text"] for r in rows(three)}
    for r in rows(four):
        assert pii.base_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
        assert r["text"] == before[r["doc_id"]] or pii.all_spans(before[r["doc_id"]], pii.selector())
    five = rows(c.best_fit_packing(spark, four, SMALL))
    assert {r["doc_id"] for r in five} == {r["doc_id"] for r in rows(four)} and len(c.STAGES) == 5


def test_pipeline_with_odd_rows(spark, docs):
    """Null ids and texts, repeated rows, further columns with clashing names, an empty table; each stage on its predecessor."""
    import corpus_pipeline as c

    extra = {"__words": F.lit(1.5), "score": F.lit("x"), "fold": F.lit(None).cast("int"), "__row": F.col("doc_id"), "piece": F.lit("y")}
    some = docs.filter("doc_id < 60").withColumns(extra)
    some = some.unionByName(some.filter("doc_id < 5")).unionByName(some.filter("doc_id = 7").withColumn("doc_id", F.lit(None).cast("long"))).unionByName(some.filter("doc_id = 8").withColumn("text", F.lit(None).cast("string")))
    for df in (some, some.limit(0)):
        now = df.cache()
        for name, stage in c.STAGES[:-1]:
            after = stage(spark, now, SMALL).cache()
            assert after.columns == df.columns and after.count() <= now.count(), name
            now = after
        last = rows(c.best_fit_packing(spark, now, SMALL))
        assert {r["doc_id"] for r in last} == {r["doc_id"] for r in rows(now)}


def test_pipeline_run_leaves_no_folder(spark):
    import corpus_pipeline as c
    from gristmill.session import shared_dir

    assert c.run(spark, SMALL).count() > 0
    assert not list(Path(shared_dir(spark).removeprefix("file:")).glob("gristmill-*"))

"""Exact duplicates, SimHash, SentencePiece, language, toxicity and attribution on odd tables and against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
import xxhash

pytest.importorskip("riftspan.llm")

from odd import TEXTS, documents  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riftspan.llm import attribution, charlm, exact, language, pieces, simhash, toxicity  # noqa: E402
from riftspan.llm.common import opened, shared, stored  # noqa: E402


def test_rice_codes_round_trip():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 1000):
        for top in (5000, 2**64 - 1):
            values = np.unique(rng.integers(0, top, size, dtype=np.uint64))
            assert (exact.rice_decode(len(values), *exact.rice_encode(values)) == values).all()


def brute_exact(texts):
    groups = collections.defaultdict(list)
    for i, t in texts:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    out = set()
    for norm, rows in groups.items():
        keep = min(rows, key=lambda r: (r[0], r[1], r[2] if r[2] is not None else 0))
        for less, _, i in rows:
            out.add((i, keep[2], len(rows), i == keep[2] and less == keep[0], hashlib.sha256(norm.encode()).hexdigest()))
    return out


def test_exact_duplicates_equal_brute_force(spark):
    rng = random.Random(2)
    many = TEXTS + [(100 + i, rng.choice(["a b", "ab", " a b", "c", "c\n", ""])) for i in range(400)]
    for texts in (TEXTS, many):
        found = exact.exact_duplicates(documents(spark, texts).repartition(5)).collect()
        got = [(r["id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["sha"]).hex()) for r in found]
        assert len(got) == len(texts)
        assert collections.Counter(r[0] for r in got) == collections.Counter(i for i, _ in texts)
        assert set(got) == brute_exact(texts)


def test_exact_duplicates_with_a_full_bitmap(spark, monkeypatch):
    monkeypatch.setattr(exact, "FILTER_BITS", 2)
    found = exact.exact_duplicates(documents(spark).repartition(3)).collect()
    assert {(r["id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["sha"]).hex()) for r in found} == brute_exact(TEXTS)


def test_without_copies_keeps_one_of_each(spark):
    docs = documents(spark)
    kept = exact.without_copies(docs).collect()
    assert kept[0].asDict().keys() == set(docs.columns)
    norms = [re.sub(r"\s", "", (r["text"] or "").replace(" ", "_")) for r in kept]
    assert len(norms) == len(set(norms)) == 6
    assert {r["doc_id"] for r in kept} == {2, 5, None, 7, 8, 9}


def brute_fingerprint(text, words=3):
    own = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    if not own:
        return 0
    shingles = [b" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, distance):
    label = {v: v for v in values}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= distance and root(a) != root(b):
                label[max(root(a), root(b))] = min(root(a), root(b))
    return {v: root(v) for v in values}


def test_fingerprints_and_classes(spark):
    texts = [(i, t) for i, t in TEXTS if i != 8] + [(20 + k, "one two three four " * 3 + "x" * k) for k in range(6)]
    got = simhash.near_classes(documents(spark, texts)).collect()
    prints = {t: brute_fingerprint(t) for _, t in texts}
    label = brute_components(set(prints.values()), 2)
    least = {}
    for i, t in texts:
        if i is not None:
            least[label[prints[t]]] = min(i, least.get(label[prints[t]], i))
    expected = {(i, prints[t], least.get(label[prints[t]])) for i, t in texts}
    assert {(r["id"], r["fp"] % 2**64, r["component_id"]) for r in got} == expected
    assert len(got) == len(set(texts))


@pytest.mark.parametrize("distance,bucket", [(2, 1000), (2, 3), (1, 1000), (5, 20)])
def test_links_connect_all_close_pairs(spark, distance, bucket):
    rng = random.Random(distance * 100 + bucket)
    values = set()
    for _ in range(25):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 40])):
            x = base
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    distinct = stored(spark.createDataFrame([(v,) for v in signed], "fp bigint"))
    edges = simhash.links(distinct, distance, bucket).collect()
    label = {v: v for v in values}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for r in edges:
        a, b = root(r["a"] % 2**64), root(r["b"] % 2**64)
        label[max(a, b)] = min(a, b)
    assert {v: root(v) for v in values} == brute_components(values, distance)


def test_one_document_of_each_class_stays(spark):
    base = " ".join(f"word{i}" for i in range(400))
    texts = [(9, base), (4, base + " more"), (4, base + " more"), (4, "something else"), (None, "without an id"), (None, "and one more"), (12, ""), (11, None)]
    docs = documents(spark, texts)
    kept = simhash.without_near_copies(docs, words=3, distance=7)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), (r["text"] or "")[:9]) for r in kept.collect()) == [
        ("11", ""), ("4", "something"), ("4", "word0 wor"), ("None", "and one m"), ("None", "without a")
    ]


def test_only_near_copies_of_what_stays_are_dropped(spark, monkeypatch):
    rng = random.Random(11)
    texts = []
    for k in range(30):
        base = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        for c in range(rng.choice([1, 2, 5])):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                own[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
            texts.append((10 * k + c, " ".join(own)))
    rng.shuffle(texts)
    texts += [(400, "alpha beta"), (401, "alpha  beta"), (402, "alpha gamma"), (None, texts[0][1])]
    sets = {(i, t): {tuple(t.split()[a : a + 5]) for a in range(max(1, len(t.split()) - 4))} for i, t in texts}

    def similarity(a, b):
        return len(sets[a] & sets[b]) / len(sets[a] | sets[b])

    expected = []
    for row in sorted(texts, key=lambda r: (r[0] is None, r[0])):
        if all(similarity(row, other) < 0.8 for other in expected):
            expected.append(row)
    # All fingerprints in one class: what goes depends on the similarity alone, whatever is linked.
    monkeypatch.setattr(simhash, "near_classes", lambda docs, *_: docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"), F.lit(0).cast("bigint").alias("component")))
    docs = documents(spark, texts).repartition(3)
    for heads in (500, 7):
        kept = simhash.without_near_copies(docs, words=3, distance=11, heads=heads).collect()
        assert {(r["doc_id"], r["text"]) for r in kept} == set(expected) and len(kept) == len(expected)


def test_linked_documents_that_are_no_near_copies_stay(spark):
    base = [f"word{i}" for i in range(60)]
    changed = ["other" if i % 10 == 0 else w for i, w in enumerate(base)]
    prints = [simhash.fingerprint(" ".join(w), 3) for w in (base, changed)]
    distance = (prints[0] ^ prints[1]).bit_count()
    docs = documents(spark, [(1, " ".join(base)), (2, " ".join(changed))])
    assert {r["doc_id"] for r in simhash.without_near_copies(docs, words=3, distance=distance).collect()} == {1, 2}


def test_thresholds_follow_the_pigeonhole_rule():
    cost, thresholds = simhash.allocate([{-1: 0.0, 0: 5.0, 1: 9.0}, {-1: 0.0, 0: 1.0, 1: 100.0}, {-1: 0.0, 0: 7.0, 1: 8.0}], 0)
    assert thresholds == [-1, 0, 1] and cost == 9.0
    groups = simhash.correlated_groups(10, np.eye(64) * 5, 3)
    assert sorted(b for g in groups for b in g) == list(range(64)) and max(map(len, groups)) <= 22


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.default_model()


def test_pieces_equal_the_library(spark, vocabulary):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=vocabulary)
    rng = random.Random(3)
    texts = TEXTS + [(1000 + i, "".join(rng.choice(" ab▁\n\té漢<s>") for _ in range(rng.randrange(25)))) for i in range(300)]
    got = pieces.encode_pieces(documents(spark, texts), vocabulary).collect()
    assert len(got) == len(texts)
    expected = collections.Counter((i, tuple(library.encode(t or "", add_bos=True, add_eos=True))) for i, t in texts)
    assert collections.Counter((r["doc_id"], tuple(r["ids"])) for r in got) == expected
    assert all(r["decoded"] == library.decode(r["ids"]) and r["n_tokens"] == len(r["ids"]) for r in got)
    digests = {r["doc_id"]: r for r in pieces.encode_pieces(documents(spark, texts[11:]), vocabulary, digests=True).collect()}
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] >= 1000:
            assert digests[r["doc_id"]]["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
            assert digests[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()


def test_kneser_ney_is_a_distribution():
    rng = np.random.default_rng(5)
    codes = np.unique(rng.integers(0, charlm.CODES, 500))
    model = charlm.KneserNey.fit(codes, rng.integers(1, 9, len(codes)))
    for context in [int(codes[3]) >> 7, 12345]:
        after = (context << 7) + np.arange(charlm.CLASSES)
        assert np.exp(model.log_probability(after)).sum() == pytest.approx(1.0, abs=1e-4)


def test_trigram_windows_do_not_cross_texts():
    table = charlm.class_table()
    together, sizes = charlm.windows(["ab c", "", "é!"], table)
    apart = [charlm.windows([t], table) for t in ("ab c", "", "é!")]
    assert together.tolist() == [c for codes, _ in apart for c in codes.tolist()]
    assert sizes.tolist() == [n for _, own in apart for n in own.tolist()]


def test_languages(spark):
    english, german = "the house and the garden with the tree ", "das haus und der garten mit dem baum "
    rows = [(i, (english if i % 2 else german) * (1 + i % 3), "en" if i % 2 else "de") for i in range(60)]
    learning = spark.createDataFrame([*rows, (61, "no language", None), (62, None, "en")], "doc_id long, text string, lang string")
    classes = spark.sparkContext.broadcast(charlm.class_table())
    models = language.train(learning, classes)
    assert models.names == ["de", "en"]
    got = {r["doc_id"]: r for r in language.identify(documents(spark), models, classes).collect()}
    assert len(got) == 10
    assert [got[i]["lang_pred"] for i in (3, 4, 5)] == ["und"] * 3 and got[3]["score"] == 0 and got[4]["rejected"]
    assert got[1]["lang_pred"] == "en" and all(0 <= r["score"] <= 1 for r in got.values())
    nothing = language.train(learning.limit(0), classes)
    assert {r["lang_pred"] for r in language.identify(documents(spark), nothing, classes).collect()} == {"und"}


def test_languages_are_calibrated_on_every_learning_row(spark):
    rng = random.Random(5)
    words = {"en": ["the", "house", "and", "with", "river"], "de": ["das", "haus", "und", "mit", "fluss"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=rng.randint(1, 8))), lang) for i in range(9_000) for lang in ("en", "de")]
    rows += [(9_500, "qxjz", "en"), (9_501, "1234", "xx"), (9_502, None, "de")]
    classes = spark.sparkContext.broadcast(charlm.class_table())
    models = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), classes)
    assert models.names == ["de", "en"]
    taught = [(text, lang) for _, text, lang in rows if text and lang in models.names]
    entropy, n = charlm.cross_entropies([text for text, _ in taught], models.models, classes.value)
    truth = np.array([models.names.index(lang) for _, lang in taught])
    own = entropy[np.arange(len(taught)), truth]
    assert np.allclose(models.limits, [np.quantile(own[truth == k], 0.999) for k in range(2)], rtol=1e-12)
    lead = (entropy - entropy.min(1, keepdims=True)) * np.sqrt(np.maximum(n, 1))[:, None]
    loss = [np.mean(np.log(np.exp(-lead * t).sum(1)) + lead[np.arange(len(taught)), truth] * t) for t in language.TEMPERATURES]
    assert models.temperature == language.TEMPERATURES[int(np.argmin(loss))]


def test_disguises_are_seen_through(spark):
    clean = "people walk along the river and talk about the weather "
    toxic = "people say you are a stupid idiot and a worthless moron "
    docs = spark.createDataFrame([(i, toxic if i % 3 == 0 else clean + str(i)) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(250)] + [(400, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    model, box = toxicity.learned(docs, labels)
    tests = {1: "a 5tup1d remark", 2: "an i d i o t here", 3: "what a m.o.r.o.n", 4: "stuuuupid idiooot", 5: "the river 2024", 6: "", 7: None}
    got = {r["doc_id"]: r for r in toxicity.score_texts(documents(spark, list(tests.items())), model, box, restored=True).collect()}
    assert all(got[i]["score"] >= 0.5 for i in (1, 2, 3, 4)), got
    assert all(got[i]["score"] < 0.5 for i in (5, 6, 7)), got
    assert got[1]["restored"] == "a stupid remark" and got[2]["restored"] == "an idiot here"
    forms = [
        "iddiioott", "sttuuppiidd", "i--d--i--o--t", "m..o..r..o..n", "stu-pid", "idi.ot", "st_upid", "i    d    i    o    t", "i\nd\ni\no\nt",
        "st up id", "y o u a r e a n i d i o t", "a s t u p i d i d i o t", "s t u p i d   i d i o t", "what,idiot", "1d!0+",
    ]
    got = {r["doc_id"]: r["score"] for r in toxicity.score_texts(documents(spark, list(enumerate(forms))), model, box).collect()}
    restorer = toxicity.Restorer(opened(box))
    assert not [(forms[i], restorer.words(forms[i])) for i, s in got.items() if s < 0.5]
    kind = ["walk along the river", "talk about the wea-ther", "p e o p l e walk", "weather, weather", "is it on or up in", "1 2 3 4 k", "$$$ 100"]
    got = toxicity.score_texts(documents(spark, list(enumerate(kind))), model, box).collect()
    assert all(r["score"] < 0.5 for r in got), got
    left = toxicity.without_toxic(documents(spark, TEXTS + [(50, "you idiot, stupid")]), labels.filter("false"))
    assert left.count() == 12 and left.columns == documents(spark).columns
    odd = toxicity.score_texts(documents(spark), model, shared(spark, toxicity.corpus_lattice(documents(spark, []))))
    assert odd.count() == len(TEXTS)


def test_decoding_finds_the_likeliest_path():
    """Against all readings of short words, listed one by one."""
    rng = random.Random(9)
    table = np.log(np.random.default_rng(5).dirichlet(np.ones(charlm.CLASSES), (charlm.CLASSES, charlm.CLASSES))).astype(np.float32)
    lattice = toxicity.Lattice(table, charlm.class_table())

    def cost(path):
        total, a, b, last = 0.0, 0, 0, ""
        for letter, kind, price, again in path:
            total += price
            if letter and again:
                if letter != last or letter == " ":
                    return math.inf
                total += toxicity.REPEATED
            elif letter:
                total -= float(table[a, b, kind])
                a, b, last = b, kind, letter
        return total - float(table[a, b, 0])

    for _ in range(40):
        w = "".join(rng.choice("ab1*0-. ss") for _ in range(rng.randrange(1, 5)))
        options = [[(*o, again) for o in lattice.readings(c) for again in ((False, True) if o[0] else (False,))] for c in w]
        best = min(cost(path) for path in itertools.product(*options))
        close = {"".join(x[0] for x in path if not x[3]) for path in itertools.product(*options) if cost(path) <= best + 1e-4}
        assert lattice.decode(w) in close, w
    assert len(lattice.decode("ab" * 20_000)) == 40_000


@pytest.mark.parametrize("rule", attribution.RULES)
def test_boundary_tokens_go_where_the_rule_says(rule):
    rng = random.Random(rule)
    for _ in range(200):
        cuts = sorted(rng.sample(range(1, 40), rng.randrange(1, 9)))
        stops = np.array([*cuts, 40])
        starts = np.array([0, *cuts])
        edges = sorted(rng.sample(range(41), 6))
        begins, ends = np.array(edges[::2]), np.array(edges[1::2])
        owner = [next((j for j in range(3) if begins[j] <= b < ends[j]), 3) for b in range(40)]
        expected = np.zeros(4)
        for a, b in zip(starts, stops):
            own = owner[a:b]
            if rule == "start":
                expected[own[0]] += 1
            elif rule == "end":
                expected[own[-1]] += 1
            elif rule == "share":
                for j in own:
                    expected[j] += 1 / (b - a)
            else:
                counts = collections.Counter(own)
                best = max(counts.values())
                expected[next(j for j in own if counts[j] == best)] += 1
        assert attribution.allocated(starts, stops, begins, ends, rule) == pytest.approx(expected)


def test_attribution_counts_every_token(spark):
    import public_tokenizers
    import tiktoken

    ranks = attribution.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = TEXTS + [(30, "Title here\n\na | b | c\nAll rights reserved."), (31, "naïve é漢字\U0001f600 text\nand more")]
    got = attribution.attribute_tokens(documents(spark, texts), attribution.lines_by_kind(F.col("text")), ranks, public_tokenizers.PATTERN, sized=True).collect()
    totals, names = collections.Counter(), collections.defaultdict(list)
    for r in got:
        totals[r["doc_id"]] += r["tokens"]
        names[r["doc_id"]].append(r["name"])
    expected = collections.Counter()
    for i, t in texts:
        expected[i] += len(encoder.encode_ordinary(t or ""))
    assert {i: n for i, n in totals.items() if n} == pytest.approx({i: n for i, n in expected.items() if n})
    assert names[30] == ["prose", "blank", "table", "notice"]
    spans = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(a).cast("long").alias("start"), F.lit(b).cast("long").alias("stop")) for n, a, b in (("a", 0, 3), ("b", 3, 99))])
    rows = attribution.attribute_tokens(documents(spark, [(1, "unbelievable things")]), spans, ranks, public_tokenizers.PATTERN, rule="share").collect()
    assert sum(r["tokens"] for r in rows) == pytest.approx(len(encoder.encode_ordinary("unbelievable things")))


def test_empty_tables(spark, vocabulary):
    none = documents(spark, [])
    assert exact.exact_duplicates(none).count() == 0
    assert exact.without_copies(none).count() == 0
    assert simhash.near_classes(none).count() == 0
    assert pieces.encode_pieces(none, vocabulary).count() == 0

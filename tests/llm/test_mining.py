"""Toxicity, the conversation trie and phrases against plain versions, on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from lakejobs.llm import phrases, prefix_trie, queries, toxicity


# --- phrases -----------------------------------------------------------------


def plain_phrases(rows, least, top, covered=80):
    """Rows (lang, text) to the reported rows."""
    f, n = Counter(), Counter()
    lower = {k: k + 32 for k in range(65, 91)}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, 5):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i : i + size])] += 1
    known = {k: v for k, v in f.items() if v >= least}
    out = defaultdict(list)
    for (lang, p), a in known.items():
        if len(p) < 2:
            continue
        inside = [
            v for (g, q), v in known.items()
            if g == lang and len(q) > len(p)
            and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        ]
        if any(100 * v >= covered * a for v in inside):
            continue
        cut = min(
            (2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))
        )
        score, k = cut
        text = " ".join(p)
        out[lang].append((-score, -a, text.encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, rank, p.decode(), -a, l, r, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1)
    }


def phrase_rows(seed=1, n=150):
    rng = random.Random(seed)
    words = "a b c d the The of ÄÖ é 中文 x-y 😀 12 *".split()
    marks = [" ", " ", " ", "  ", "\t", " \t ", ". ", ", ", "\n", ";", "!?", "\r\n", "\x0b"]
    out = [(1, None, "en"), (2, "", None), (3, " \t ", "en"), (4, "...", "de"), (None, "the of", "en")]
    for k in range(n):
        text = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 60)))
        out.append((k, text, rng.choice(["en", "en", "de", None, ""])))
    out += [out[20]] * 7
    out.append((900, " ".join(rng.choices(words, k=6000)), "en"))
    return out


def phrase_docs(spark, rows):
    return spark.createDataFrame(
        [(*r, "clash", 1, 2) for r in rows],
        "doc_id long, text string, lang string, phrase string, n int, shard int",
    )


@pytest.mark.parametrize("shards", [1, 2, 3])
def test_phrases_against_plain(spark, shards):
    rows = phrase_rows(shards)
    mining = phrases.Mining(min_count=6, shards=shards, cells=1 << 16, top=40)
    got = phrases.collocations(phrase_docs(spark, rows), mining=mining).collect()
    want = plain_phrases([(g, t) for _, t, g in rows], 6, 40)
    assert {(r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got} == want
    assert len(got) == len(want)


def test_phrases_when_cells_collide(spark):
    """A full table starts phrases too early but changes no count."""
    rows = phrase_rows(9, 60)
    mining = phrases.Mining(min_count=4, shards=2, cells=8, top=30)
    got = phrases.collocations(phrase_docs(spark, rows), mining=mining).collect()
    want = plain_phrases([(g, t) for _, t, g in rows], 4, 30)
    assert {(r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got} == want


def test_phrases_of_an_empty_table(spark):
    mining = phrases.Mining(cells=1 << 10)
    assert phrases.collocations(phrase_docs(spark, []), mining=mining).count() == 0
    only_null = [(1, None, None), (2, "", "en")]
    assert phrases.collocations(phrase_docs(spark, only_null), mining=mining).count() == 0


def test_cuts_keep_phrases_whole():
    """Counts do not depend on where a text is cut, whatever lies at the cut."""
    rng = random.Random(4)
    text = "".join(rng.choice(["ab", "c", "dd ", " ", "\t", ". ", "\n", "é"]) for _ in range(3000)).encode()
    reached = np.zeros(1 << 10, np.uint8)

    def counts(size):
        total = Counter()
        parts = list(phrases.chunks(text, size))
        for k in range(0, len(parts), 3):
            for length, _, found, sizes in phrases.scan(parts[k : k + 3], "en", reached, 1, 2):
                names = found.to_pylist()
                assert len(set(names)) == len(names)
                total.update(dict(zip(names, sizes.tolist())))
        return total

    whole = counts(1 << 20)
    for size in (1, 2, 7, 50, 999):
        assert counts(size) == whole


def test_long_word_and_long_piece():
    """One word of a million characters, and a million words without a separator."""
    word, many = b"x" * 1_000_000, b"ab cd " * 500_000
    reached = np.zeros(1 << 10, np.uint8)
    total = Counter()
    for part in phrases.chunks(word + b"\n" + many):
        for length, _, found, sizes in phrases.scan([part], "en", reached, 1, 2):
            for f, n in zip(found.to_pylist(), sizes.tolist()):
                total[f] += n
    assert total["x" * 1_000_000] == 1
    assert total["ab"] == total["cd"] == total["ab cd"] == 500_000
    assert total["ab cd ab cd"] == total["cd ab cd"] == 499_999


# --- conversation trie -------------------------------------------------------


def spark_hash(*parts):
    """XXH64 chained over the parts, as a signed number."""
    seed = 42
    for p in parts:
        data = p.encode() if isinstance(p, str) else p.to_bytes(4, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def plain_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = (turn is not None, turn or 0, spark_hash(role, text))
            convs[conv].append((key, role, text))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        family = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(family, [])[:h] + turns[h:])
    nodes = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes[path[:d]].append(c)
    children = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if built[c] == p)))
        out.append((
            min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children[p],
            leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def conversations_of(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, "x") for r in rows],
        "conv_id long, turn long, role string, text string, depth int, a string",
    )


def turns_of(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 900), n) + [0, 100, 200, 300]:
        for k in range(rng.randint(1, 12)):
            turn = rng.choice([k, k, k, None, 0])
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["", None, "é😀", "hi", "x" * 9])))
    rows += rows[:9]
    rows += [(None, 1, "user", "nobody's"), (7_777_777, None, None, None)]
    rows += [(c, k, "user", f"same {k}") for c in range(2000, 2040) for k in range(9)]
    return rows


def trie_rows(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("screen", [
    prefix_trie.Screen(),
    # A sketch so small that it proves next to nothing, and conversations in pieces.
    prefix_trie.Screen(max_cells=64, piece=2),
])
def test_trie_against_plain(spark, screen):
    rows = turns_of(3, 160)
    got = prefix_trie.conversation_trie(conversations_of(spark, rows), screen=screen)
    assert trie_rows(got) == plain_trie(rows)


def test_trie_of_few_rows(spark):
    empty = prefix_trie.conversation_trie(conversations_of(spark, []))
    assert empty.count() == 0 and "ends_sha256" in empty.columns
    for rows in ([(None, 0, "user", "x")], [(5, None, None, None)], [(3, 0, "user", "a")] * 3):
        got = prefix_trie.conversation_trie(conversations_of(spark, rows))
        assert trie_rows(got) == plain_trie(rows)


def test_trie_of_a_long_conversation(spark):
    """Two equal long conversations: a chain that both share."""
    rows = [(c, k, "user", f"turn {k}") for c in (4100, 4200, 4303) for k in range(400)]
    rows += [(4303, 400, "user", "one more"), (4100, 401, None, "y" * 1_000_000)]
    got = prefix_trie.conversation_trie(conversations_of(spark, rows))
    assert trie_rows(got) == plain_trie(rows)


# --- toxicity ----------------------------------------------------------------


def plain_ftrl(rows, params):
    """The update rule coordinate by coordinate, over sets of places."""
    z, n = defaultdict(float), defaultdict(float)
    constant = 1 << params.bits

    def weight(j):
        l1 = 0.0 if j == constant else params.l1
        if abs(z[j]) <= l1:
            return 0.0
        sign = 1 if z[j] > 0 else -1
        return -(z[j] - sign * l1) / ((params.beta + n[j] ** 0.5) / params.alpha + params.l2)

    for _ in range(params.rounds):
        for places, label in rows:
            at = [*places, constant]
            w = {j: weight(j) for j in at}
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            for j in at:
                sigma = ((n[j] + g * g) ** 0.5 - n[j] ** 0.5) / params.alpha
                z[j] += g - sigma * w[j]
                n[j] += g * g
    return {j: weight(j) for j in z if weight(j) or j == constant}


def test_weights_follow_the_rule():
    rng = random.Random(2)
    params = toxicity.Ftrl(bits=12, l1=0.4, rounds=2)
    rows = [(sorted(rng.sample(range(200), rng.randint(0, 30))), rng.randint(0, 1)) for _ in range(300)]
    got = toxicity.trained([(np.array(p, np.int32), y) for p, y in rows], params)
    got = dict(zip(got["place"].to_pylist(), got["weight"].to_pylist()))
    want = plain_ftrl(rows, params)
    assert got.keys() == want.keys()
    assert all(abs(got[j] - want[j]) < 1e-9 for j in want)


def test_features_do_not_depend_on_the_stretch(monkeypatch):
    rng = random.Random(5)
    text = " ".join(rng.choices("You are a clown. Ünder_x 12 é".split(), k=500))
    whole = toxicity.features(text, 20)
    for stretch in (1, 2, 3, 7, 100):
        monkeypatch.setattr(toxicity, "STRETCH", stretch)
        assert (toxicity.features(text, 20) == whole).all()


def toxic_tables(spark, n=900):
    rng = random.Random(8)
    plain = "the of and thing that under over line text more".split()
    bad = "moron scum".split()
    docs, labels = [], []
    for k in range(n):
        words = rng.choices(plain, k=rng.randint(5, 60))
        toxic = int(k % 7 == 0)
        if toxic:
            words += rng.choices(bad, k=3)
            rng.shuffle(words)
        docs.append((k, " ".join(words)))
        labels.append((k, toxic))
    docs += [(n, None), (n + 1, ""), (None, "a text"), (5, docs[5][1]), (n + 2, "moron " * 200_000)]
    labels += [(n, None), (None, 1), (n + 1, 0), (3, None), (99_999, 1), (5, labels[5][1])]
    d = spark.createDataFrame([(*r, 1.0, "x") for r in docs], "doc_id long, text string, score double, label string")
    lab = spark.createDataFrame([(*r, 1) for r in labels], "doc_id long, toxic int, score int")
    return d, lab


def test_toxic_documents_are_found(spark):
    docs, labels = toxic_tables(spark)
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.held_out == held
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    judged = [r for r in got if r.held_out and r.doc_id < 900]
    right = sum(r.predicted == int(r.doc_id % 7 == 0) for r in judged)
    assert len(judged) > 100 and right >= 0.98 * len(judged)
    assert next(r for r in got if r.doc_id == 902).predicted == 1


def test_held_out_labels_are_not_looked_at(spark):
    docs, labels = toxic_tables(spark, 300)
    flipped = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) AS toxic"
    )
    one = {tuple(r) for r in toxicity.score_documents(docs, labels).collect()}
    two = {tuple(r) for r in toxicity.score_documents(docs, flipped).collect()}
    assert one == two


def test_toxicity_without_labels(spark):
    docs, labels = toxic_tables(spark, 20)
    got = toxicity.score_documents(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in got} == {(0.0, 0)}
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0


def test_held_out_accuracy_of_the_query(spark):
    """On the given tables: the area under the curve of the documents held out."""
    sf = "/root/testdata/sf0.1"
    scored = queries.op11_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = scored.where("held_out").join(labels, "doc_id").select("score", "toxic").collect()
    good = sorted(r.score for r in rows if r.toxic == 0)
    bad = [r.score for r in rows if r.toxic == 1]
    below = np.searchsorted(good, bad, "left") + np.searchsorted(good, bad, "right")
    assert below.sum() / (2 * len(good) * len(bad)) > 0.97
    assert sum(r.score >= 0.5 for r in rows if r.toxic == 0) <= 0.01 * len(good)
    assert sum(s >= 0.5 for s in bad) >= 0.7 * len(bad)

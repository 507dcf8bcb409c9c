"""Each operator against a plain-Python version of what it computes."""
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from verity.llm import bands, bpe, ctw, embed, licenses, minhash, mixing, pii, spans, toxicity
from verity.llm.queries import tokenizer_path

DATA = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def crafted_copies(seed=3):
    """Texts with chains of near copies: a chain's ends are not alike."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for group in range(6):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([30, 120, 400]))]
        for _ in range(12):
            out.append(" ".join(text))
            text = list(text)
            for _ in range(rng.choice([0, 1, 2])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
    out += ["", "  ", "one two", "One  TWO", "one two three", "one two three four five"]
    order = list(range(len(out)))
    rng.shuffle(order)
    return [(i, out[k]) for i, k in enumerate(order)]


def near_groups(rows):
    sets = {}
    for i, text in rows:
        w = words(text.translate(FOLD))
        sets[i] = ({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}) if w else set()
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                hi, lo = sorted((root(a), root(b)), reverse=True)
                label[hi] = lo
    return {(i, len(sets[i]), root(i), root(i) == i) for i in ids}


def test_minhash_components(spark):
    rows = crafted_copies()
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == near_groups(rows)


def test_minhash_blocks_meet(spark, monkeypatch):
    """Lists longer than a block: every pair of blocks is compared."""
    rows = crafted_copies(5)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == near_groups(rows)


def test_minhash_misses_fewer_than_one_in_1e7():
    """Of pairs of similarity exactly 0.75, by the binomial distribution."""
    miss = lambda n, p, m: sum(math.comb(n, k) * p**k * (1 - p)**(n - k) for k in range(m))
    rate = miss(minhash.COORDINATES, 0.75, minhash.MATCHES) + miss(minhash.FINE, 0.75 + 0.25 / 256, minhash.FINE_MATCHES)
    assert rate < 1e-7


def test_bpe_equals_the_tokenizer(spark, texts):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(7)
    rows = [(i, t) for i, t in list(texts.items())[:60]]
    letters = ["abcdefgh", "ab", "éèüñßaİΣσ", "日本語テスト", "0123456789", "the"]
    for k in range(40):
        run = "".join(rng.choice(rng.choice(letters)) for _ in range(rng.randrange(1, 900)))
        rows.append((10_000 + k, run if k % 3 else f"a {run} it's <|endoftext|>{run}'s x <|startoftext|>"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    small = bpe.encode_long(df, tokenizer_path(), bpe.Staging(spark, "test-bpe"), leaf=64, piece=8)
    whole = bpe.encode(df, tokenizer_path())
    expected = {i: library.encode(t, add_special_tokens=False).ids for i, t in rows}
    assert {r.doc_id: r.ids for r in small.collect()} == expected
    assert {r.doc_id: r.ids for r in whole.collect()} == expected
    decoded = {r.doc_id: r.text for r in bpe.decode(whole, tokenizer_path()).collect()}
    assert decoded == {i: library.decode(x, skip_special_tokens=False) for i, x in expected.items()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in bpe.round_trip(df, tokenizer_path(), leaf=500).collect():
        ids = expected[r.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(" ".join(map(str, ids))), sha(decoded[r.doc_id]))


def test_bpe_join_is_exact():
    v = bpe.vocabulary(tokenizer_path())
    rng = random.Random(11)
    for _ in range(300):
        token = "".join(rng.choice(["a", "b", "th", "ing", "aa", "er"]) for _ in range(rng.randrange(2, 80)))
        cut = rng.randrange(1, len(token))
        assert v.join(v.merge(token[:cut], False), v.merge(token[cut:], True), True) == v.merge(token, True)


def test_vector_links(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 24))
    for i in range(100, 300):  # groups of noisy copies, some of them exact
        x[i] = x[i % 9] + rng.normal(size=24) * (0.0 if i % 5 == 0 else 0.08)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    label = np.arange(300)
    for _ in range(300):
        label = np.where(near, label[None, :], 300).min(1)
    got = sorted(embed.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    exact = near.sum(1) - 1
    assert sum(r.n_links for r in got) >= 0.97 * exact.sum() and all(r.n_links <= e for r, e in zip(got, exact))
    assert [r.component_id for r in got] == label.tolist()


def test_vector_shards_meet(spark, monkeypatch):
    """One cluster far above the shard size: shards search each other."""
    monkeypatch.setattr(embed, "SHARD", 40)
    rng = np.random.default_rng(5)
    base = rng.normal(size=16)
    rows = [(i, [float(c) for c in base + rng.normal(size=16) * 0.05]) for i in range(200)]
    got = embed.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sum(r.n_links for r in got) >= 0.97 * 200 * 199 and {r.component_id for r in got} == {0}


def test_spans(docs, texts):
    first = {}
    for i in sorted(texts):
        for a, _, h in spans.spans(spans.sentences(texts[i])):
            first.setdefault(h, (i, spans.text_key(texts[i]), a))
    for r in spans.remove_repeated_spans(docs).collect():
        units = spans.sentences(texts[r.doc_id])
        gone = {k for a, b, h in spans.spans(units) if first[h] != (r.doc_id, spans.text_key(texts[r.doc_id]), a)
                for k in range(a, b)}
        assert (r.n_sentences, r.n_removed, r.changed) == (len(units), len(gone), bool(gone))
        assert r.text.lower().split() == [w for k, u in enumerate(units) if k not in gone for w in u[2]]
        assert gone or r.text == texts[r.doc_id]


def test_cut_of_a_batch():
    """Texts cut together equal each cut alone, by a plain statement of it."""
    rng = random.Random(12)

    def plain(text):
        out, n, at = [], 0, 0
        for piece in re.split(r"(?<=\n)|(?<=[.!?])(?=\s)", text):
            found = [(at + m.start(), at + m.end(), m.group().lower()) for m in re.finditer(r"\S+", piece)]
            at += len(piece)
            begins = {0}
            if len(found) > spans.LONG:
                h = [int(spans._word_hashes(c := spans._codes(w), np.array([0]), np.array([len(c)]))[0]) for _, _, w in found]
                for k in range(len(h) - spans.LONG + 1):
                    begins.add(min(range(k, k + spans.LONG), key=lambda i: (h[i], i)))
            cuts = [*sorted(begins), len(found)]
            if found:
                out += [(found[a][0], found[b - 1][1], [w for _, _, w in found[a:b]], n) for a, b in zip(cuts, cuts[1:])]
                n += 1
        return out

    texts = ["", " \n ", "İ. A"]
    for _ in range(600):
        some = ["a", "B?", "c.", "d.e", "...", "\n", "İx", "🙂", "é!"] + [f"w{i}" for i in range(30)] * rng.randrange(3)
        texts.append("".join(rng.choice(some) + rng.choice([" ", " ", "  ", "\t", "\x1c", "\n" if rng.random() < .1 else " "])
                             for _ in range(rng.randrange(60))))
    found = spans.cut(texts)
    base = [u[0][3] if (u := spans.units_of(found, k)) else 0 for k in range(len(texts))]
    for k, text in enumerate(texts):
        want = plain(text)
        assert spans.sentences(text) == want
        assert [(a, b, w, n - base[k]) for a, b, w, n in spans.units_of(found, k)] == want


def test_passage_is_caught_and_clean_text_left(spark):
    rng = random.Random(2)
    sentence = lambda: " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(6, 16))).capitalize() + "."
    own = [" ".join(sentence() for _ in range(6)) for _ in range(20)]
    passage = " ".join(sentence() for _ in range(6))
    rows = [(i, f"{t}\n{passage}\n{sentence()}" if i in (3, 8, 15) else t) for i, t in enumerate(own)]
    got = {r.doc_id: r for r in spans.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i in got if got[i].changed] == [8, 15] or sorted(i for i in got if got[i].changed) == [8, 15]
    assert passage in got[3].text and passage not in got[8].text and got[0].text == rows[0][1]


def test_no_run_of_50_words_is_left_twice(spark):
    """Passages at any offset of sentences of any length, also unpunctuated."""
    rng = random.Random(8)

    def prose(n, stop):
        return [f"w{rng.randrange(10**5)}" + ("." if rng.random() < stop else "") for _ in range(n)]
    passages = [prose(rng.choice([50, 51, 60, 90]), stop) for stop in (0, 0, 0.02, 0.05, 0.1, 0.2) for _ in range(4)]
    rows = []
    for i in range(60):
        w = prose(rng.randrange(40), stop := rng.choice([0, 0.03, 0.15]))
        for p in rng.sample(passages, 2):
            w += p + prose(rng.randrange(1, 40), stop)
        rows.append((i, " ".join(w)))

    def runs(pairs):
        held = collections.defaultdict(set)
        for i, t in pairs:
            w = t.lower().split()
            for k in range(len(w) - 49):
                held[tuple(w[k:k + 50])].add(i)
        return [x for x in held.values() if len(x) > 1]
    assert len(runs(rows)) > 24
    got = spans.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert runs([(r.doc_id, r.text) for r in got]) == []


def test_two_sentences_of_few_words_are_a_span(spark):
    passage = "This one sentence holds exactly nine words of text. And the next one has nine of them too."
    rows = [(1, f"An own beginning. {passage} An own end."), (2, f"Other words first. {passage} And others last.")]
    got = {r.doc_id: r.text for r in spans.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1] and "nine" not in got[2] and got[2].startswith("Other words first.")


def test_spans_end_at_every_sentence():
    """Each sentence begins and ends a shortest run, where there is one."""
    rng = random.Random(4)
    for _ in range(200):
        sizes = [rng.choice([1, 3, 5, 9, 12, 30]) for _ in range(rng.randrange(1, 12))]
        units = spans.sentences(" ".join(" ".join(["w"] * n) + "." for n in sizes))
        enough = lambda i, j: j - i >= 2 and (n := sum(len(u[2]) for u in units[i:j])) >= 16 and (
            n >= 25 or units[i][3] != units[j - 1][3])
        every = [(i, j) for j in range(len(units) + 1) for i in range(j) if enough(i, j)]
        short = {(i, min(j for k, j in every if k == i)) for i, _ in every} | \
            {(max(i for i, k in every if k == j), j) for _, j in every}
        got = [(i, j) for i, j, _ in spans.spans(units)]
        assert set(got) == short and len(got) == len(short)


def test_last_short_sentences_of_a_passage_go(spark):
    passage = [" ".join(f"{name}{k}" for k in range(n)) + "." for name, n in (("a", 20), ("b", 20), ("c", 5), ("d", 5))]
    rows = [(i, " ".join([f"own{i} " * 3 + "words.", *passage, f"tail{i} " * 3 + "words."])) for i in (1, 2)]
    got = {r.doc_id: r.text for r in spans.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1] and got[2].split() == ["own2"] * 3 + ["words."] + ["tail2"] * 3 + ["words."]


def test_context_tree(docs, texts):
    depth = 3
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0

    def path(t):
        b = [ctw.START] * depth + list(t.encode()) + [ctw.END]
        for k in range(depth, len(b)):
            for s in range(8):
                yield tuple(b[k - depth:k]), (b[k] | 256) >> (8 - s), b[k] >> (7 - s) & 1

    counts = collections.defaultdict(lambda: [0, 0])
    for i, t in texts.items():
        if not held(i):
            for x, z, bit in path(t):
                for d in range(depth + 1):
                    counts[x[depth - d:], z][bit] += 1
    g = math.lgamma
    kt = lambda a, b: g(a + .5) + g(b + .5) - math.log(math.pi) - g(a + b + 1)
    weighted, children = {}, collections.defaultdict(float)
    for d in range(depth, -1, -1):
        for (x, z), (a, b) in counts.items():
            if len(x) == d:
                own, rest = kt(a, b), children[x, z]
                weighted[x, z] = own if d == depth else \
                    max(own, rest) + math.log(.5) + math.log1p(math.exp(-abs(own - rest)))
                if d:
                    children[x[1:], z] += weighted[x, z]
    got = {r.doc_id: r for r in ctw.score_texts(docs, depth=depth).collect()}
    known = collections.Counter(w for i, t in texts.items() if not held(i) for w in words(t.translate(FOLD)))
    n_texts = sum(not held(i) for i in texts)
    n, v = sum(known.values()) + n_texts, len(known) + 1
    price = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    for i, t in list(texts.items())[:40]:
        score = 0.0
        for x, z, bit in path(t):
            left, one = 1.0, 0.0
            for d in range(depth + 1):
                node = x[depth - d:], z
                a, b = counts.get(node, (0, 0))
                stop = 1.0 if d == depth else math.exp(math.log(.5) + kt(a, b) - weighted.get(node, 0.0))
                one += left * stop * (b + .5) / (a + b + 1)
                left *= 1 - stop
            score += math.log10(one if bit else 1 - one)
        own = [known[w] for w in words(t.translate(FOLD))] + [n_texts]
        assert got[i].score == pytest.approx(score, rel=1e-5)
        assert got[i].base_score == pytest.approx(sum(map(price, own)), rel=1e-9)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(own), sum(c > 0 for c in own), n)
        assert got[i].held_out == held(i)


def test_context_tree_probabilities_add_up():
    """Over all 256 next bytes of a context the prices are a distribution."""
    rng = np.random.default_rng(1)
    grams = np.unique(rng.integers(0, 4, 200) << 24 | 65 << 16 | 66 << 8 | rng.integers(0, 256, 200))
    seen = np.arange(256) | 65 << 16 | 66 << 8 | 2 << 24
    every = np.unique(np.concatenate([grams, seen]))
    counts = np.where(np.isin(every, grams), 3, 0)
    tree = ctw.Subtree(every, counts, 3)
    price = tree.log_prices(np.ones(256), np.zeros(256))
    assert np.exp(price[np.isin(every, seen)]).sum() == pytest.approx(1.0)


def test_mixing(docs, texts, spark):
    rows = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    size = {i: len(words(t)) for i, t in texts.items()}
    per = collections.Counter()
    for i, s in rows.items():
        per[s] += size[i]
    names = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, left = {}, dict(per)
    while left:  # share, stop what is above three times its size, share again
        rest = sum(per.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        above = [s for s in left if share[s] > 3 * per[s] + 1e-9]
        target.update({s: 3.0 * per[s] for s in above} if above else share)
        left = {s: 1 for s in left if s not in target}
    taken = collections.Counter()
    plan = mixing.mix_plan(docs).collect()
    for r in plan:
        assert r.size == size[r.doc_id] and r.source_size == per[r.source]
        assert r.target == pytest.approx(target[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(taken[s] == math.floor(next(r.target for r in plan if r.source == s)) for s in per)
    assert sorted(plan) == sorted(mixing.mix_plan(docs.repartition(7)).collect())
    out = mixing.mix(docs).collect()
    assert sum(len(words(r.text)) for r in out) == sum(taken.values())


def luhn(digits):
    return sum(int(c) * 2 - 9 * (int(c) > 4) if k % 2 else int(c) for k, c in enumerate(reversed(digits))) % 10 == 0


def test_pseudonyms(spark):
    values = {
        "card": "4041 8949 7460 8795", "phone": "+1 (988) 555-2485", "ssn": "123-45-6789", "date": "2024-02-29",
        "email": "John.42@mail8.example.com", "ip": "70.123.182.155",
    }
    assert luhn(re.sub(r"\D", "", values["card"]))
    text = "Said " + " then ".join(values.values()) + "."
    rows = [(1, text), (2, values["card"].replace(" ", "-") + " and " + values["email"].lower()),
            (3, "4041894974608796 or 300.1.1.1 or 000-12-3456 or 2023-02-29 or version 2.0."), (4, "nothing")]
    got = {r.doc_id: r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), key="k").collect()}
    new = {x.kind: x.value for x in got[1].pii_values}
    assert [x.kind for x in got[1].pii_values] == list(values)
    assert got[1].text == "Said " + " then ".join(new[k] for k in values) + "."
    shape = lambda s: re.sub(r"[a-z]", "a", re.sub(r"\d", "0", s.lower()))
    for k, v in values.items():
        assert v not in got[1].text
        assert shape(new[k]) == shape(v) or k == "ip"
    assert luhn(re.sub(r"\D", "", new["card"])) and new["card"][0] == "4"
    assert re.fullmatch(r"(19|20)\d\d-\d\d-\d\d", new["date"]) and new["phone"].startswith("+1 (")
    # The same values in another document and spelling.
    assert got[2].text == new["card"].replace(" ", "-") + " and " + new["email"]
    assert got[3].n_pii == 0 and got[3].text == rows[2][1] and got[4].text == "nothing"
    other = pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), key="other").filter("doc_id = 1").first()
    assert other.text != got[1].text


def test_cards_beside_other_digits(spark):
    cards = ["4111 1111 1111 1111", "5500-0000-0000-0004", "3782 822463 10005", "4222222222222"]
    around = ["{}", "{} 09/27", "{} 123", "order 12 {}", "1234 {}", "{} 4321 x", "7 {} 12 34", "{} 09/27/2024",
              "{} 2024-02-29", "123-45-6789 {}", "{} 988-555-2485", "{} 10.0.0.1", "{}, {}", "{} {}", "{}  {}"]
    rows = [(100 * a + c, shape.format(card, card)) for a, shape in enumerate(around) for c, card in enumerate(cards)]
    rows += [(9001, "4111 1111 1111 1112 10"), (9002, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(df, key="k").collect()}
    new = {c: got[c].text for c in range(len(cards))}
    for c, card in enumerate(cards):
        assert new[c] != card and luhn(re.sub(r"\D", "", new[c])) and re.sub(r"\d", "0", new[c]) == re.sub(r"\d", "0", card)
    for i, text in rows[:-2]:
        shape, card = around[i // 100], cards[i % 100]
        kinds = [x.kind for x in got[i].pii_values]
        assert kinds.count("card") == shape.count("{}") and card not in got[i].text, (text, got[i])
        assert new[i % 100] in got[i].text and len(kinds) == shape.count("{}") + (
            any(x in shape for x in ("2024", "6789", "988", "10.0"))), (text, got[i])
    assert all(got[i].n_pii == 0 and got[i].text == text for i, text in rows[-2:])


def test_pseudonyms_are_a_permutation(spark):
    from pyspark.sql import functions as F
    days = spark.sql("SELECT explode(sequence(DATE'1900-01-01', DATE'1903-12-31')) AS d").select(
        F.col("d").cast("string").alias("text"))
    got = [r.text for r in pii.pseudonymise(days).select("text").collect()]
    assert len(set(got)) == len(got) == 1460 and sorted(got)[0] > "1900" and len({d[:4] for d in got}) > 150
    small = spark.range(30).select(pii.permute_pair(F.floor(F.col("id") / 5), F.col("id") % 5, 6, 5, "k", "t").alias("p"))
    assert {(r.p.a, r.p.b) for r in small.collect()} == {(a, b) for a in range(6) for b in range(5)}


def test_bands(docs, texts, spark):
    for r in bands.score_quality(docs).collect():
        w, lines = words(texts[r.doc_id]), texts[r.doc_id].split("\n")
        windows = collections.Counter(zip(w, w[1:], w[2:]))
        repeated = {k + j for k in range(len(w) - 2) if windows[tuple(w[k:k + 3])] > 1 for j in range(3)}
        seen, dup = set(), 0
        for line in filter(words, lines):
            dup += line in seen
            seen.add(line)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(texts[r.doc_id].count(c) for c in "#*$%&|<>"), dup, len(repeated))
        assert r.base_failed == (len(w) < 50 or 100 * len(repeated) > 50 * len(w)) and not (r.base_failed and r.kept)
    rng = random.Random(1)
    noise = " ".join("".join(chr(rng.randrange(33, 0x2FF)) for _ in range(8)) for _ in range(400))
    prose = next(t for t in texts.values() if len(t) > 3000)
    rows = [(1, "one two three four five six seven eight nine ten\n" * 60), (2, noise), (3, prose)]
    got = {r.doc_id: r for r in bands.score_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not got[1].kept and not got[2].kept and got[2].ratio < 1.4


def test_block_max_is_exact():
    rng = np.random.default_rng(9)
    rows = rng.random((500, 40)) * (rng.random((500, 40)) < 0.1)
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    index = toxicity.Index([f"t{i}" for i in range(40)], np.ones(40), rows, np.arange(500), (np.arange(500) % 2),
                           np.ones(500), 0.5)
    for _ in range(50):
        f = np.flatnonzero(rng.random(40) < 0.1)
        w = index.vector(f, np.ones(len(f)))
        at, cos = index.nearest(f, w)
        full = index.rows[:, f] @ w if len(f) else np.zeros(500)
        best = [i for i in np.lexsort((np.arange(500), -np.round(full, 12)))[:toxicity.K] if full[i] > 0]
        assert at.tolist() == best and np.allclose(cos, full[best])


def test_toxicity_held_out_accuracy(spark):
    rng = random.Random(6)
    vocabulary, bad = [f"v{i}" for i in range(3000)], ["vile", "rotten", "nasty", "foul"]
    rows, labels = [], []
    for i in range(1500):
        toxic = int(rng.random() < 0.2)
        w = [rng.choice(vocabulary) for _ in range(60)]
        for _ in range(4 * toxic):
            w[rng.randrange(60)] = rng.choice(bad)
        rows.append((i, " ".join(w)))
        labels.append((i, toxic))
    got = {r.doc_id: r for r in toxicity.score_toxicity(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i, _ in held) and sum(r.held_out for r in got.values()) == len(held)
    assert sum(got[i].predicted == y for i, y in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(any(e.toxic for e in got[i].evidence) for i, y in held if got[i].predicted)


def test_licences(spark):
    rows = [
        (1, "Text. Licensed under the Apache License, Version 2.0. The MIT\nLICENSE; more mit-license."),
        (2, "x " * 100 + "permission hereby granted free charge, any person obtaining a copy of this software and its "
            "associated documentation files " + "y " * 100),
        (3, "limit license and permit licenses"), (4, "")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (3, 4, 13, "apache,mit")
    assert got[1].score == 1.0 and got[1].n_words == 15
    assert got[2].n_base == 0 and got[2].labels == "mit" and got[2].base_labels == "" and 0.8 <= got[2].score < 1
    for i in (3, 4):
        assert (got[i].labels, got[i].score, got[i].first_word) == ("", 0.0, None)

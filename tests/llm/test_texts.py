"""Text operators against plain versions, on odd rows, on no rows and on the documents of sf0.01."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import xxhash
from llm.conftest import ordered
from tallybook.llm import bpe, chunks, mixing, pii, repetition, simhash, tokens
from tokenizers import Tokenizer

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def measures(text):
    words, seen, lines, dup, chars = WORDS.findall(text), set(), 0, 0, 0
    for line in text.split("\n"):
        if WORDS.search(line):
            lines += 1
            if line in seen:
                dup, chars = dup + 1, chars + sum(map(len, WORDS.findall(line)))
            seen.add(line)
    out = [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, dup, chars]
    for n in (3, *repetition.GRAM_PERCENT):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        often = Counter(grams)
        inside = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + n)}
        out.append(len(inside) if n == 3 else sum(len(words[i]) for i in inside))
    return out


def test_quality(docs):
    want = sorted([(i, *measures(t)) for i, t in rows_of(docs)], key=repr)
    assert ordered(repetition.measures(docs)) == want
    judged = repetition.judge(docs)
    kept = sorted([r.doc_id for r in judged.collect() if r.kept], key=repr)
    assert sorted([r.doc_id for r in repetition.keep(docs).collect()], key=repr) == kept
    for r in judged.collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed)


def fingerprint(text):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Smallest index reachable over fingerprints at most two bits apart."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                low, high = sorted((root(i), root(j)))
                label[high] = low
    return [root(i) for i in range(len(prints))]


def expected_components(rows):
    prints = [fingerprint(t) for _, t in rows]
    roots, least = groups(prints), {}
    for (i, _), g in zip(rows, roots):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return [(i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, roots)]


def test_simhash(docs):
    want = expected_components(rows_of(docs))
    assert ordered(simhash.near_duplicates(docs)) == sorted(want, key=repr)
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema
    heads = {(c, c is None) for _, _, c in want}
    assert sorted((r.doc_id for r in kept.collect() if r.doc_id is not None)) == sorted(c for c, _ in heads if c is not None)


def test_simhash_crowded_bucket(spark, monkeypatch):
    """Links through neighbourhoods are those through pivots."""
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(40)]
    prints = sorted({b ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for b in base for _ in range(12)} | set(base))
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    want = groups(prints)
    for limit in (64, 1):
        monkeypatch.setattr(simhash, "BUCKET", limit)
        from tallybook.llm.components import components
        from tallybook.staging import Stage

        stage = Stage(spark)
        found = {r.node % (1 << 64): r.component for r in components(simhash.links(nodes, stage), stage).collect()}
        mine = {}
        for p, g in zip(prints, want):
            mine.setdefault(g, set()).add(found.get(p, p))
        assert all(len(s) == 1 for s in mine.values()) and len({min(s) for s in mine.values()}) == len(mine)


def test_bpe(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, want = Tokenizer.from_file(path), []
    for i, text in rows_of(docs):
        ids = library.encode(text, add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    encoded = bpe.encode(docs, path)
    assert ordered(encoded) == sorted(want, key=repr)
    assert ordered(bpe.decode(encoded, path)) == sorted([(i, d) for i, _, d in want], key=repr)
    hexes = [(i, len(t), hashlib.sha256(" ".join(map(str, t)).encode()).hexdigest(), hashlib.sha256(d.encode()).hexdigest())
             for i, t, d in want]
    assert ordered(bpe.encode(docs, path, derive=bpe.digests())) == sorted(hexes, key=repr)


def test_token_counts(docs, tmp_path):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    want = sorted([(i, len(t.encode()), len(model.encode(t)), len(model.encode(t)) > 4096) for i, t in rows_of(docs)], key=repr)
    cache = str(tmp_path / "cache")
    assert ordered(tokens.count_tokens(docs, path, cache)) == want
    stored = docs.sparkSession.read.schema(tokens.CACHE).parquet(cache).count()
    assert stored == len({t for _, t in rows_of(docs)})
    assert ordered(tokens.count_tokens(docs, path, cache)) == want  # warm: nothing is appended
    assert docs.sparkSession.read.schema(tokens.CACHE).parquet(cache).count() == stored


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, found):
    digits = [int(c) for c in found if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [d * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text) if passes(k, m.group())]


def test_pii(docs):
    want = []
    for i, text in rows_of(docs):
        found = base_spans(text) if len(text) < 50_000 else []
        kinds = Counter(k for k, *_ in found)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        want.append((i, *[kinds[k] for k in pii.BASE_KINDS], hashlib.sha256(listed.encode()).hexdigest()))
    assert ordered(pii.digests(pii.find(docs)).drop("spans")) == sorted(want, key=repr)
    assert pii.mask(docs).count() == docs.count()


def test_pii_scan_equals_patterns():
    rnd = random.Random(3)
    bits = ["a@b.c", "@", "x.y+z@q-r.s.t", "1.2.3.4", "1.2.3.4.5", "256.1.1.1", "0001.02.3.255", "+1 (555) 123-4567", "+", "12",
            "4111 1111 1111 1111", "4111-1111-1111-1111 2", "a@b", "b.c@d..e", " ", "-", ".", "\u00e9", "1@2.3.4.5.6", "\n"]
    for _ in range(3000):
        text = "".join(rnd.choice(bits) + rnd.choice(["", " "]) for _ in range(rnd.randint(1, 12)))
        assert [s[:3] for s in pii.spans_of(text) if s[4]] == base_spans(text), text


def test_pii_added_kinds():
    kinds = [s[0] for s in pii.spans_of("amex card 378282246310005; DE89 3704 0044 0532 0130 00; ssn 123-45-6789")]
    assert kinds == ["iban", "ssn", "shortcard"]
    assert pii.spans_of("number 378282246310005; DE88 3704 0044 0532 0130 00; 123-45-6789") == []
    assert pii.masked("to a@b.c or +1 (555) 123-4567.") == "to [EMAIL] or [PHONE]."


def test_mixing(docs):
    rows = mixing.mix(docs).collect()
    sizes = sorted([(i, len(WORDS.findall(t))) for i, t in rows_of(docs)], key=repr)
    assert sorted([(r.doc_id, r.size) for r in rows], key=repr) == sizes
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    own = Counter()
    for r in docs.collect():
        own[r.source] += len(WORDS.findall(r.text or ""))
    names = sorted(own, key=lambda s: (s is None, s))
    weights, left, target = {s: i % 3 + 1 for i, s in enumerate(names)}, set(names), {}
    rest = sum(own.values())
    while left:
        level = rest / sum(weights[s] for s in left)
        over = {s for s in left if level * weights[s] > 3 * own[s]}
        target |= {s: 3.0 * own[s] for s in over} if over else {s: level * weights[s] for s in left}
        rest, left = rest - sum(3 * own[s] for s in over), left - over if over else set()
    assert sorted({(r.source_size, round(r.target, 6)) for r in rows}) == sorted({(own[s], round(target[s], 6)) for s in names})
    assert abs(sum(r.taken for r in rows) - sum(r.size for r in rows)) <= 64 * (len(names) + 1)
    assert ordered(mixing.mix(docs)) == sorted(map(tuple, rows), key=repr)
    mixed = mixing.mixed(docs)
    assert mixed.schema.names == docs.schema.names
    assert sum(len(WORDS.findall(r.text)) for r in mixed.collect()) == sum(r.taken for r in rows)


@pytest.mark.parametrize("weights,seats", [([5, 3, 1], 9), ([100, 1, 1, 0], 50), ([7] * 6, 4), ([1, 2, 3, 4, 5], 1000)])
def test_sainte_lague(spark, weights, seats):
    won = [0] * len(weights)
    for _ in range(seats):
        won[max(range(len(weights)), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))] += 1
    df = spark.createDataFrame([(i, float(w), seats) for i, w in enumerate(weights)], "i int, w double, seats long")
    assert [r.got for r in mixing.apportion(df, [], "i", "w", "seats", "got").orderBy("i").collect()] == won


def test_passages(docs, spark):
    found = {r.doc_id for r in chunks.repeated_passages(docs).collect()}
    if docs.count() == 13:
        assert found >= {6, 7}
    rnd = random.Random(1)
    vocabulary = ["".join(rnd.choice(["th", "er", "on", "an", "re", "in"]) for _ in range(rnd.randint(1, 4))) for _ in range(3000)]

    def text(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))

    rows = []
    for k in range(60):
        passage = text(55)
        rows += [(2 * k + q, f"{text(rnd.randint(30, 200))}{' ' if q else chr(10)}{passage} {text(80)}") for q in range(2)]
    clean = [(1000 + k, text(300)) for k in range(100)]
    got = {r.doc_id: r for r in chunks.repeated_passages(spark.createDataFrame(rows + clean, "doc_id long, text string")).collect()}
    assert set(got) == {i for i, _ in rows}
    assert all((got[i].removed_words > 0) == (i % 2 == 1) for i in got)

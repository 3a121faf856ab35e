import base64
import json
import random
import re
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from cases import CLASHING, passages, plain_components, plain_dedup, plain_fingerprint, rows_of, table
from farelane.llm import bpe, bwt, contamination, recompression, repeats, secrets, simhash, suite, toxicity

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def odd(spark):
    rows = passages()
    return rows, table(spark, rows).cache()


@pytest.fixture(scope="module")
def nothing(odd):
    return odd[1].limit(0)


# ---------------------------------------------------------------- SimHash


def test_fingerprint_is_the_majority_of_shingle_hashes():
    for _, text in passages(9, 40):
        assert simhash.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("fixed", [0, 5, 22])
def test_trie_finds_every_close_pair(fixed, monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (400, 3), dtype=np.uint64)
    near = centre[rng.integers(0, 40, 400)] ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2]
    words = np.unique(np.concatenate((centre, near, [np.uint64(0)])))
    found = {(min(a, b), max(a, b)) for i, j in simhash.trie_pairs(words, fixed) for a, b in zip(i.tolist(), j.tolist())}
    want = set()
    for a in range(len(words)):
        for b in range(a + 1, len(words)):
            x = int(words[a] ^ words[b])
            if x.bit_count() <= 2 and x >> (64 - fixed) == 0:
                want.add((a, b))
    assert found == want


def test_masks_leave_no_close_pair_out():
    rng = random.Random(1)
    levels = simhash.mask_levels()
    assert [len(x) for x in levels] == [3, 18, 108]
    for _ in range(2000):
        d = (1 << rng.randrange(64)) | (1 << rng.randrange(64))
        assert any(not d & m for m in levels[0])
        for k, children in ((k, levels[1][6 * k : 6 * k + 6]) for k in range(3)):
            if not d & levels[0][k]:
                assert any(not d & m for m in children)
        assert any(not d & m for m in levels[2])


def test_near_classes_equal_brute_force(spark, odd, monkeypatch):
    rows, df = odd
    prints = [plain_fingerprint(t) for _, t in rows]
    root = plain_components(rows, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    least: dict = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(least.get(root[k], i), i)
    want = sorted(((i, f"{p:016x}", least.get(root[k])) for k, ((i, _), p) in enumerate(zip(rows, prints))), key=repr)
    assert rows_of(simhash.near_classes(df)) == want


def test_hot_groups_are_dealt_again_without_loss(spark):
    rng = np.random.default_rng(4)
    flips = [np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64) for _ in range(3)]
    words = np.unique(np.uint64(0x123456789ABCDEF0) ^ flips[0] ^ flips[1] ^ flips[2])
    prints = spark.createDataFrame([(int(x),) for x in words.view(np.int64)], "fp long")
    from farelane.llm.graph import components

    def classes(group):
        found = components(simhash.links(prints, group)).collect()
        name = {r.node: r.root for r in found}
        return {int(x): name.get(int(x), int(x)) for x in words.view(np.int64)}

    want = plain_components(list(words), lambda a, b: int(words[a] ^ words[b]).bit_count() <= 2)
    for group in (1000, 20):
        got = classes(group)
        assert len(set(got.values())) == len(set(want.values()))


def test_nothing_gives_nothing(spark, nothing):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert simhash.near_classes(nothing).count() == 0
    assert contamination.contamination(nothing, bench).count() == 0
    assert contamination.find_matches(nothing, bench).count() == 0
    assert secrets.scan_secrets(nothing).count() == 0
    assert bpe.tokenize(nothing, PATH, public_tokenizers.PATTERN).count() == 0
    assert bwt.dedup_bytes(nothing).count() == 0
    assert recompression.dedup_words(nothing).count() == 0
    model = toxicity.fit(nothing, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(nothing, model).count() == 0


# ---------------------------------------------------------------- decontamination

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _plain_hits(text, items, window=13):
    words = _WORD.findall((text or "").translate(_LOWER))
    hit, names = set(), set()
    for name, item in items:
        own = _WORD.findall((item or "").translate(_LOWER))
        size = min(window, len(own))
        for s in range(len(own) - size + 1 if own else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == own[s : s + size]:
                    hit.update(range(at, at + size))
                    names.add("null" if name is None else str(name))
    return len(words), len(hit), ",".join(sorted(names)), len(names)


ITEMS = [
    (10, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"), (9, "THE of. the, OF"), (2, None), (3, ""), (4, "..."), (None, "w5 w6 w7"),
    (10, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"), (11, "a " * 13), (12, "日本 é"),
]


def test_contamination_equals_brute_force(spark, odd):
    rows, df = odd
    rows = rows + [(2000, "x W1-w2_w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14"), (2001, "w5 w6 w7 " + "q " * 57), (2002, "w5 w6 w7 " + "q " * 58)]
    df = table(spark, rows)
    got = {}
    for r in contamination.contamination(df, spark.createDataFrame(ITEMS, "item_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append(tuple(r)[1:])
    want: dict = {}
    for i, text in rows:
        n, hit, names, k = _plain_hits(text, ITEMS)
        want.setdefault(i, []).append((n, hit, k, sha256(names.encode()).hexdigest(), hit > 0 and 20 * hit >= n))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert [got[k][0][-1] for k in (2000, 2001, 2002)] == [True, True, False]


def test_benchmark_in_blocks_gives_the_same(spark, odd, monkeypatch):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = rows_of(contamination.contamination(odd[1], bench))
    monkeypatch.setattr(contamination, "BLOCK", 10)
    assert rows_of(contamination.contamination(odd[1], bench)) == whole


def test_longest_matches_have_places(spark):
    text = "p q " + " ".join(f"w{k}" for k in range(3, 16)) + " z"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    assert rows_of(contamination.find_matches(docs, bench)) == [(1, 2, 10, 2, 13, 13)]
    docs = spark.createDataFrame([(1, "p " + ITEMS[0][1])], "doc_id long, text string")
    assert [(r.doc_start, r.item_start, r.longest) for r in contamination.find_matches(docs, bench).orderBy("doc_start").collect()] == [(1, 0, 15), (2, 1, 14), (3, 2, 13)]


# ---------------------------------------------------------------- repeats


def test_byte_dedup_equals_brute_force(odd):
    assert rows_of(bwt.dedup_bytes(odd[1])) == sorted(plain_dedup(odd[0], str.encode), key=repr)


def test_word_dedup_equals_brute_force(odd):
    assert rows_of(recompression.dedup_words(odd[1])) == sorted(plain_dedup(odd[0], lambda t: t.encode().split()), key=repr)


def test_windows_around_one_word_named_in_different_rounds(spark):
    """Windows around one word, of runs on both sides, close in different rounds; the shared window has another left neighbour."""
    rows = []
    for b in range(12):
        for k in range(1, 49, 4):
            window = ["a"] * k + [f"b{b}"] + ["a"] * (49 - k)
            rows.append((len(rows), " ".join(["a", *window, "c", *(f"e{len(rows)}.{x}" for x in range(5))])))
            rows.append((len(rows), " ".join([f"d{len(rows)}", *window, "c", *(f"e{len(rows)}.{x}" for x in range(5))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(recompression.dedup_words(docs)) == sorted(plain_dedup(rows, lambda t: t.encode().split()), key=repr)


@pytest.mark.parametrize("method", [bwt.Bytes(), recompression.Words()])
@pytest.mark.parametrize("hot, segment", [(3, 1 << 16), (1000, 130), (3, 130)])
def test_hot_anchors_and_long_texts(method, hot, segment, monkeypatch):
    """The rounds in process: buckets and parts as plain lists."""
    import pyarrow as pa

    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "SEGMENT", segment)
    rows = [(i, t) for i, t in passages(5, 60) if i is not None and i != 905]
    buckets, parts = 4, 4
    dealt = [[] for _ in range(buckets)]
    for i, t in rows:
        dealt[hash(t) % buckets].append((sha256((t or "").encode()).hexdigest(), i, (t or "").encode()))
    tables = [pa.table({k: [r[n] for r in d] for n, k in enumerate(("digest", "least", "text"))}, schema=pa.schema([("digest", pa.string()), ("least", pa.int64()), ("text", pa.binary())])) for d in dealt]
    key = lambda k: (pa.scalar(k, pa.int32()),)
    group = lambda made, name, k: made.filter(pa.compute.equal(made[name], k))
    asked = pa.concat_tables([repeats._ask_anchors(method, parts)(key(k), t) for k, t in enumerate(tables)])
    told = pa.concat_tables([repeats._meet_anchors(key(p), group(asked, "part", p)) for p in range(parts)])
    asked = pa.concat_tables([repeats._ask_passages(method, parts)(key(k), t, group(told, "bucket", k)) for k, t in enumerate(tables)])
    told = pa.concat_tables([repeats._meet_passages(method)(key(p), group(asked, "part", p)) for p in range(parts)])
    found = {}
    for k, t in enumerate(tables):
        for r in repeats._finish(method)(key(k), t, group(told, "bucket", k)).to_pylist():
            found[r["digest"]] = (r["n"], r["n_removed"], r["n_spans"], r["kept"])
    least: dict = {}
    for i, t in rows:
        least[t or ""] = min(least.get(t or "", i), i)
    units = str.encode if isinstance(method, bwt.Bytes) else lambda t: t.encode().split()
    for i, *want in plain_dedup([(i, t) for t, i in least.items()], units):
        text = next(t for t, k in least.items() if k == i and found[sha256(t.encode()).hexdigest()] == tuple(want))
        assert text is not None


def test_run_index_streams_the_matches_of_a_suffix_array():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 84, 60)
    body = rng.integers(97, 99, int(size.sum())).astype(np.uint8)
    index = bwt.RunIndex(body, size)
    assert len(index.heads) < len(index.text)
    match, before = index.matching()
    start = np.cumsum(size) - size
    strings = [body[s : s + n].tobytes() for s, n in zip(start, size)]
    suffixes = sorted((w[k:], t, k) for t, w in enumerate(strings) for k in range(len(w) + 1))
    base = np.cumsum(size + 1) - size - 1
    for (x, t, k), (y, u, m) in zip(suffixes, suffixes[1:]):
        n = next((n for n, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
        assert (before[base[u] + m], match[base[u] + m]) == (base[t] + k, n)


def test_equal_windows_have_equal_anchors():
    rng = random.Random(2)
    words = recompression.Words()
    for size in (50, 64, 90):
        middle = [rng.choice("abcdef") for _ in range(size)]
        seen = []
        for _ in range(6):
            left, right = [rng.choice("abcdef") for _ in range(rng.randint(0, 70))], [rng.choice("abcdef") for _ in range(70)]
            units = words.units(" ".join(left + middle + right).encode())
            place, key = words.anchors(units, units)
            at = slice(len(left), len(left) + size - 49)
            seen.append(((place[at] - len(left)).tolist(), key[at].tolist()))
        assert all(s == seen[0] for s in seen)


# ---------------------------------------------------------------- secrets


def _pem(der: bytes) -> str:
    body = base64.b64encode(der).decode()
    return "-----BEGIN PRIVATE KEY-----\n" + "\n".join(re.findall(".{1,64}", body)) + "\n-----END PRIVATE KEY-----"


def _der(n: int = 200) -> bytes:
    inner = b"\x02\x01\x00" + b"\x30\x03\x06\x01\x2a" + b"\x04\x81" + bytes([n]) + bytes(range(n))
    return b"\x30\x81" + bytes([len(inner)]) + inner if len(inner) < 256 else b"\x30\x82" + len(inner).to_bytes(2, "big") + inner


def test_structure_decides():
    head = base64.urlsafe_b64encode(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()).decode().rstrip("=")
    no_head = base64.urlsafe_b64encode(json.dumps({"typ": "JWT"}).encode()).decode().rstrip("=")
    kinds = lambda t: [k for k, _, _ in secrets.confirmed_spans(t)]
    assert kinds(f"é {head}.eyJhIjoxfQ.c2ln") == ["jwt"]
    assert kinds(f"{no_head}.eyJhIjoxfQ.c2ln") == []
    assert kinds(_pem(_der())) == ["pem"]
    assert kinds(_pem(_der()[:-1])) == []
    assert kinds(base64.b64encode(_der()).decode()) == ["der"]
    assert kinds(base64.b64encode(b"\x30\x81\xf0" + b"no key at all " * 20).decode()) == []
    assert kinds("x=" + _der().hex()) == ["der"]
    ssh = len(b"ssh-ed25519").to_bytes(4, "big") + b"ssh-ed25519" + (32).to_bytes(4, "big") + bytes(32)
    assert kinds("ssh-ed25519 " + base64.b64encode(ssh).decode()) == ["ssh_public"]
    assert kinds("ssh-ed25519 " + base64.b64encode(ssh[:-1]).decode()) == []


def test_keys_in_any_dress():
    """Keys with escaped line ends, headers, short sequences, wrapped lines, the other alphabet, or upper-case hex digits."""
    whole = lambda t, kind: [(k, a, b) for k, a, b in secrets.confirmed_spans(f"x: {t} y")] == [(kind, 3, 3 + len(t))]
    escaped = _pem(_der()).replace("\n", "\\n")
    assert whole(escaped, "pem") and whole(escaped.replace("\\n", "\\r\\n"), "pem") and whole(_pem(_der()).replace("\n", "\r\n"), "pem")
    assert secrets.redacted('{"key": "' + escaped + '\\n"}') == '{"key": "[SECRET]\\n"}'
    lines = "\n".join(re.findall(".{1,64}", base64.b64encode(bytes(range(96))).decode()))
    locked = f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{'0A' * 16}\n\n{lines}\n-----END RSA PRIVATE KEY-----"
    assert whole(locked, "pem") and whole(locked.replace("\n", "\\n"), "pem")
    assert not secrets.confirmed_spans(locked.replace("DEK-Info", "Comment"))
    short = bytes.fromhex("302e020100300506032b657004220420") + bytes(range(7, 39))
    text = base64.b64encode(short).decode()
    assert len(text) == 64 and whole(text, "der") and whole(_pem(short), "pem")
    assert not secrets.confirmed_spans(base64.b64encode(short[:-1]).decode())
    for size in (197, 198, 199):
        for wide in (64, 76):
            pieces = re.findall(f".{{1,{wide}}}", base64.b64encode(_der(size)).decode())
            for end in ("\n", "\r\n", "\n  ", "\\n"):
                assert whole(end.join(pieces), "der")
            assert [k for k, *_ in secrets.confirmed_spans("\n".join([*pieces, "then more words"]))] == ["der"]
        cert = "\n".join(["-----BEGIN CERTIFICATE-----", *pieces, "-----END CERTIFICATE-----"])
        assert not secrets.confirmed_spans(cert)
    for shift in range(4):
        inner = short[2:-32] + bytes([0xFB, 0xFF, 0xFE, 0x3E][shift:] + [0xFB] * (28 + shift))
        url = base64.urlsafe_b64encode(short[:2] + inner).decode()
        assert ("-" in url or "_" in url) and whole(url, "der")
    assert whole(_der().hex().upper(), "der") and whole(_der().hex().upper()[:90] + _der().hex()[90:], "der")
    signature = b"\x30\x44\x02\x20" + bytes(range(1, 33)) + b"\x02\x20" + bytes(range(1, 33))
    assert not secrets.confirmed_spans(base64.b64encode(signature).decode())


def test_base_spans_follow_the_patterns(spark):
    text = "é PassWord: 'abcdef' token=abc api_key=\"A/b+c=.-_9\" AKIA" + "A" * 16 + " AKIA123 " + "0" * 24 + " " + "f" * 23 + " ſecret=abcdefgh Key"
    found = secrets.base_spans(text)
    assert [(k, text[a:b]) for k, a, b in found] == [
        ("assign", "PassWord: 'abcdef"), ("assign", 'api_key="A/b+c=.-_9'), ("access", "AKIA" + "A" * 16), ("hex", "0" * 24),
    ]
    rows = [(1, text), (2, None), (3, ""), (None, text), (1, text)]
    got = rows_of(secrets.scan_secrets(table(spark, rows)))
    base = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(found, key=lambda s: s[1]))
    clean = (0, 0, 0, 0, sha256(b"").hexdigest(), "")
    full = (2, 1, 1, 0, sha256(base.encode()).hexdigest(), base)
    assert got == sorted([(1, *full), (1, *full), (None, *full), (2, *clean), (3, *clean)], key=repr)


def test_redaction_replaces_secrets_only():
    assert secrets.redacted(None) is None
    assert secrets.redacted("plain") == "plain"
    assert secrets.redacted("a token=abcdefgh b") == "a [SECRET] b"
    assert secrets.redacted("secret=" + "0" * 30 + ".") == "[SECRET]"


# ---------------------------------------------------------------- toxicity


def _toxic_rows(n=1200):
    rng = random.Random(8)
    words = [f"n{k}" for k in range(300)]
    rows = []
    for i in range(n):
        toxic = i % 6 == 0
        w = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        for _ in range(2 if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "awful", "rotten"]))
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_held_out_rows_are_told_apart(spark):
    rows = _toxic_rows()
    docs = table(spark, [(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (None, "vile vile"), (0, rows[0][1])])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (7, None), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, learn=suite.fold() != 0)
    assert 0 < len(model.keys) < 2000
    got = toxicity.score(docs, model).join(labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL"), "doc_id").filter(suite.fold() == 0).toPandas()
    assert ((got["score"] >= 0.5) == got["toxic"].astype(bool)).mean() > 0.97
    assert (got["predicted"] == (got["score"] >= 0.5)).all()
    alone = {r.doc_id: r.score for r in toxicity.score(docs, model).filter("doc_id >= 5000").collect()}
    assert alone[5000] == alone[5001] < 0.5
    kept = toxicity.keep_clean(docs, model)
    assert kept.schema == docs.schema and 900 < kept.count() < 1100


def test_no_labels_reject_nothing(spark):
    docs = table(spark, [(1, "a b c"), (2, None)])
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.predicted for r in toxicity.score(docs, model).collect()] == [0, 0]


def test_one_label_only(spark):
    docs = table(spark, [(k, f"a b c{k}") for k in range(30)])
    model = toxicity.fit(docs, spark.createDataFrame([(k, 0) for k in range(30)], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity.score(docs, model).collect()} == {0}


def test_the_sample_is_bounded(spark):
    rows = _toxic_rows(400)
    docs, labels = table(spark, [(i, t) for i, t, _ in rows]), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, spec=toxicity.Spec(sample=100))
    assert toxicity.score(docs, model).count() == 400


# ---------------------------------------------------------------- tokens


@pytest.fixture(scope="module")
def known():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tokens_equal_the_library_on_random_text(known):
    assert bpe.KNOWN == public_tokenizers.PATTERN
    rng = random.Random(1)
    letters = "'stremdvl  \n\t  aé日1½٣.!'\"🙂\x1c\x85\r\0"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    texts += [None, "", " ", "'", "'s", "''s", " 's", "a'll", "a'l", "'ve", "x  ", "a" * 20_000, "ab" * 300 + "é" * 200, "\n" * 500 + " x"]
    want = [known.encode_ordinary(t or "") for t in texts]
    for pattern in (public_tokenizers.PATTERN, public_tokenizers.PATTERN + "|x^"):
        encode = bpe.Encoder(bpe.vocabulary(PATH), pattern, most=200)
        for _ in range(2):  # the second time from memory
            tokens, counts = encode(texts)
            assert counts.tolist() == [len(w) for w in want]
            assert tokens.tolist() == [k for w in want for k in w]
    assert bpe.vocabulary(PATH).decode(tokens) == "".join(t or "" for t in texts).encode()


def test_tokenize_rows(odd, known):
    rows, df = odd
    got = rows_of(bpe.tokenize(df, PATH, public_tokenizers.PATTERN, with_ids=True))
    want = []
    for i, t in rows:
        ids = known.encode_ordinary(t or "")
        want.append((i, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256((t or "").encode()).hexdigest(), ids))
    assert got == sorted(want, key=repr)


def test_clashing_columns_are_really_there(odd):
    assert set(CLASHING) < set(odd[1].columns)

"""The operators of secrets, vector codes and token alignment against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import bisect
import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from vivarium.llm import secret_links, token_alignment, vector_codes

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, key string, base string, spans string, n_a long, pairs string, label string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "k", "b", "s", 1, "p", "l") for i, t in enumerate(texts)], DOCS)


# 11


def brute_secrets(text):
    """base, and all spans, by trying all pairs."""
    text = text or ""
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    weak = [(m.start(), 3, m.end()) for m in re.finditer(r"""(?:access|account|client|tenant|user)[_-]?(?:id|name|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)""", text, re.I | re.A) if len(m[1]) >= 3]
    weak += [(m.start(), 4, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z0-9]", text)]
    weak += [(m.start(), 5, m.end()) for m in re.finditer(r"(?:https?|ftp|mongodb|postgres|postgresql|mysql|redis|amqp|s3)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+", text, re.I | re.A)]
    weak += [(m.start(), 6, m.end()) for m in re.finditer("[A-Za-z0-9+/_=-]+", text) if len(m[0]) >= 16 and re.search("[0-9]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[a-z]", m[0])]
    around = [x for x in found + weak if x[1] in (0, 3, 4, 5)]
    inner = {x for x in found + weak if x[1] in (2, 6) and any(y < x and y[2] > x[0] for y in around)}
    gaps = [m.end() for m in re.finditer(r"\n[\x20\t\r]*\n", text)]
    scope = lambda x: bisect.bisect_right(gaps, x[0])
    every = [x for x in found + weak if not (x[1] == 6 and x in inner)]

    def near(x, kinds):
        for y in every:
            if y != x and y[1] in kinds and y not in inner and scope(x) == scope(y) and (x[0] - y[2] <= 300 if y < x else y[0] - x[2] <= 300):
                return True
        return False

    told = [x for x in weak if x in every and {3: lambda: near(x, (0, 2, 6)), 4: lambda: near(x, (0, 2, 6)), 6: lambda: near(x, (1, 3, 4)), 5: lambda: near(x, (1, 3, 4)) and near(x, (0, 2, 6))}[x[1]]()]
    say = lambda spans: ",".join(f"{('assign', 'access', 'hex', 'identifier', 'account', 'endpoint', 'value')[k]}:{s}:{e}" for s, k, e in sorted(spans))
    return [sum(k == n for _, k, _ in found) for n in range(3)], hashlib.sha256(say(found).encode()).hexdigest(), say(found + told)


def random_secrets(seed):
    r = random.Random(seed)
    h = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    mixed = lambda n: "".join(r.choice("abcXYZ0123456789+/") for _ in range(n))
    bits = [
        lambda: "word " * r.randrange(1, 90), lambda: "\n\n", lambda: "\n \t\n", lambda: "\n", lambda: f'token = "{h(40)}" ', lambda: f"PassWord:{mixed(r.randrange(3, 9))} ", lambda: "token=token:abcdefgh ", lambda: f"AKIA{h(r.randrange(8, 24)).upper()} ",
        lambda: h(r.randrange(20, 30)) + " ", lambda: f"client_id={mixed(r.randrange(1, 30))} ", lambda: f'User-Name: "bob{r.randrange(99)}" ', lambda: f"https://api.example.com/v1?k={mixed(20)} ", lambda: f"postgres://u:p@h:5432/{h(24)} ", lambda: mixed(r.randrange(10, 40)) + " ", lambda: f"{mixed(4)}bob.{h(9)}@mail.example.com_x@b.c ", lambda: "é🤷 ſecret=abcdefgh toKen = 'q' ",
    ]
    return "".join(r.choice(bits)() for _ in range(r.randrange(2, 25)))


def test_secrets_against_brute_force(spark):
    texts = [None, "", " ", *[random_secrets(k) for k in range(150)], "user_id=bob " + "x " * 160 + "token=abcdefgh", "user_id=bob\n\ntoken=abcdefgh", "user_id=bob\ntoken=abcdefgh", ("token=abc1 user_id=bob12 AKIA" + "Q" * 20 + " ") * 2000]
    got = {r.doc_id: ([r.n_assign, r.n_access, r.n_hex], r.base_sha256, r.spans) for r in secret_links.secret_spans(docs(spark, texts)).collect()}
    for i, t in enumerate(texts[:-1]):
        assert got[i] == brute_secrets(t), t
    assert got[len(texts) - 1][0] == [0, 2000, 0] and got[len(texts) - 1][2].count("access") == 2000
    assert got[len(texts) - 2][2].startswith("identifier") and "identifier" not in got[len(texts) - 3][2] and "identifier" not in got[len(texts) - 4][2]


def test_secrets_repeats_nulls_and_empty(spark):
    text = "client_id=abc token=abcdefgh"
    rows = spark.createDataFrame([(1, text), (1, text), (None, text), (2, None)], "doc_id long, text string")
    got = secret_links.secret_spans(rows).collect()
    assert sorted((r.doc_id or 0, r.n_assign, r.spans) for r in got) == [(0, 1, "identifier:0:13,assign:14:28"), (1, 1, "identifier:0:13,assign:14:28"), (1, 1, "identifier:0:13,assign:14:28"), (2, 0, "")]
    assert secret_links.secret_spans(rows.limit(0)).count() == 0


# 12


def brute_codes(rows):
    """By vec_id: code, error; and the codebooks."""
    kept = sorted(((i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = max(1, -(-len(kept[0][1]) // 4))
    x = np.array([v + [0] * (4 * width - len(v)) for _, v in kept], np.int64).reshape(len(kept), 4, width)
    books = [x[:256, p].copy() for p in range(4)]
    pick = lambda p: ((x[:, p, None] - books[p][None]) ** 2).sum(-1).argmin(1)
    for _ in range(4):
        for p in range(4):
            got = pick(p)
            for e in set(got.tolist()):
                books[p][e] = x[got == e, p].sum(0) // (got == e).sum()
    codes = [pick(p) for p in range(4)]
    error = sum(((x[:, p] - books[p][codes[p]]) ** 2).sum(1) for p in range(4))
    return Counter((i, "".join(f"{codes[p][k]:02x}" for p in range(4)), int(error[k])) for k, (i, _) in enumerate(kept)), hashlib.sha256(",".join(str(v) for b in books for v in b.ravel()).encode()).hexdigest()


VECTORS = "vec_id long, embedding array<float>, label int, code string, error long, n long"


@pytest.mark.parametrize("seed,length,n", [(1, 16, 700), (2, 8, 300), (3, 6, 40), (4, 4, 5000)])
def test_codes_against_brute_force(spark, seed, length, n):
    r = np.random.default_rng(seed)
    x = r.normal(0, 1, (n, length)) if seed % 2 else r.integers(-2, 3, (n, length)) / 2  # ties
    x = (x + r.integers(0, 5, (n, 1)) * 3).astype(np.float32)
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    rows += [(n, None), (n + 1, [1.0] * (length - 1) + [None]), (n + 2, [float("nan")] * length), (n + 3, [float("-inf")] * length), (n + 4, [0.5] * (length + 4)), (5, rows[9][1]), (5, rows[9][1]), (None, rows[3][1])]
    labels = [None if k % 7 == 0 else k % 5 for k in range(len(rows))]
    df = spark.createDataFrame([(i, v, labels[k], "c", 1, 2) for k, (i, v) in enumerate(rows)], VECTORS)
    got = vector_codes.vector_codes(df).collect()
    want, digest = brute_codes(rows)
    assert Counter((g.vec_id, g.code, g.error) for g in got) == want and {g.codebooks_sha256 for g in got} == {digest}
    total = defaultdict(int)
    for g in vector_codes.coded(*vector_codes.codebooks(df)).collect():
        total[g.label] += g.error
    assert sorted(Counter(g.label_error for g in got)) == sorted(set(total.values()))
    salted = vector_codes.with_label_error(vector_codes.coded(*vector_codes.codebooks(df)), broadcast_labels=0)
    assert Counter((g.vec_id, g.label_error) for g in salted.collect()) == Counter((g.vec_id, g.label_error) for g in got)


def test_codes_of_no_vectors(spark):
    df = spark.createDataFrame([(1, None, 1, "c", 1, 2), (2, [float("nan")], 1, "c", 1, 2)], VECTORS)
    assert vector_codes.vector_codes(df).count() == 0 and vector_codes.vector_codes(df.limit(0)).count() == 0
    one = vector_codes.vector_codes(spark.createDataFrame([(1, [], 1, "c", 1, 2), (2, [], None, "c", 1, 2)], VECTORS)).collect()
    assert [(r.code, r.error, r.label_error) for r in one] == [("00000000", 0, 0)] * 2


def test_tree_search_equals_all_distances():
    r = np.random.default_rng(5)
    for trial in range(40):
        n, width, m = int(r.integers(1, 900)), int(r.integers(1, 20)), int(r.choice([1, 2, 3, 7, 100, 256]))
        x = [r.integers(-3, 4, (n, width)), r.normal(0, 1000, (n, width)).astype(int), (r.integers(0, 6, (n, 1)) * 5000 + r.normal(0, 20, (n, width))).astype(int), np.full((n, width), 2)][trial % 4].astype(np.int64)
        entries = np.ascontiguousarray(x[:m])
        x = x[: max(1, int(n * r.random()))]  # also fewer points than entries
        n = len(x)
        tree = vector_codes.Tree(x, 32)
        tree = vector_codes.Tree.unpacked(tree.packed(), n, width, tree.levels)
        codes, total, count = vector_codes.nearest(tree, vector_codes.Tree(entries, 1))
        want = ((x[:, None] - entries[None]) ** 2).sum(-1).argmin(1)
        sums = np.zeros(entries.shape, np.int64)
        np.add.at(sums, want, x)
        assert (codes == want[tree.order]).all() and (count == np.bincount(want, minlength=len(entries))).all() and (total == sums).all()


def test_whole_nodes_are_assigned(monkeypatch):
    """Of clusters far apart, no leaf is compared point by point."""
    x = np.repeat(np.arange(8) * 1000, 512)[:, None] + np.random.default_rng(1).integers(0, 5, (4096, 4))
    tree, entries = vector_codes.Tree(x, 32), vector_codes.Tree(np.arange(8)[:, None] * 1000 + np.zeros((1, 4), np.int64), 1)
    monkeypatch.setattr(np, "argmin", None)
    codes, _, count = vector_codes.nearest(tree, entries)
    assert count.tolist() == [512] * 8 and (codes == x[tree.order, 0] // 1000).all()


# 13


@pytest.fixture(scope="module")
def paths():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def brute(paths):
    import sentencepiece
    from tokenizers import Tokenizer

    a_side, b_side = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a_side.encode_special_tokens = True
    chars = token_alignment.byte_characters()

    def one(text):
        """ids of A and of B, groups as text, links; None without tokens."""
        if not text:
            return None
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
        spell_a = [bytes(chars[c] for c in a_side.id_to_token(i)) for i in a]
        spell_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(b_side.id_to_piece, b)]
        if not b"".join(spell_a) == b"".join(spell_b) == (" " + text).encode():
            return None
        ends = [np.cumsum([len(t) for t in s]).tolist() for s in (spell_a, spell_b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in cuts]
        for side, ids in enumerate((a, b)):
            for i, e in zip(ids, ends[side], strict=True):
                groups[bisect.bisect_left(cuts, e)][side].append(i)
        links, at = [], 0
        for i, (e, s) in enumerate(zip(ends[0], [0, *ends[0]], strict=False)):
            while ends[1][at] <= s:
                at += 1
            j = at
            while j < len(b) and (ends[1][j - 1] if j else 0) < e:
                links.append((a[i], b[j]))
                j += 1
        return a, b, ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups), links

    return one


HOSTILE = ["", None, " ", "  ", "a ", " a", "a  b", "a \n b\n\n c", "<s> </s> <|endoftext|>", "é▁q", "x  y", "　 z   k", "日本語 テキスト", "a\tb \t c", "🤷🏽 ok", "q" * 5000, "é" * 300, "don't  we'll", "\x1c a", "\x00 b", "ﬁ ① x", "<0x41> <0x0A>", "\r\n \r\n", "same", "same", "n\n", "n\n ", "x ", "word " * 9000]


@pytest.mark.parametrize("told", [token_alignment.TOLD, 900])
def test_alignment_against_brute_force(spark, paths, brute, told):
    r = random.Random(7)
    texts = HOSTILE + [t for (t,) in duckdb.execute(f"SELECT text FROM '{SF}/documents.parquet' LIMIT 60").fetchall()]
    texts += ["".join(r.choice(["a", "é", " ", "  ", "\n", "▁"[: r.random() < 0.02], "Wort", "🤷", " ", "12", "'s", "\t"]) for _ in range(r.randrange(40))) for _ in range(150)]
    every = [brute(t) for t in texts]
    counts = Counter(p for x in every if x for p in set(x[3]))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    want = []
    for i, x in enumerate(every):
        a, b, groups, links = x or ([], [], "", [])
        want.append((i, len(a), len(b), groups.count(";") + 1 if x else 0, len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if x else ""))
    got = token_alignment.token_alignment(docs(spark, texts).repartition(3), *paths, told=told)
    assert sorted((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got.collect()) == want


def test_alignment_repeats_nulls_and_empty(spark, paths, brute):
    rows = spark.createDataFrame([(1, "to be"), (1, "to be"), (None, "to be"), (2, None)], "doc_id long, text string")
    for told in (token_alignment.TOLD, 1):
        got = token_alignment.token_alignment(rows, *paths, told=told).collect()
        assert sorted((r.doc_id or 0, r.n_links, r.count_sum) for r in got) == [(0, 2, 6), (1, 2, 6), (1, 2, 6), (2, 0, 0)]
    assert token_alignment.token_alignment(rows.limit(0), *paths).count() == 0


def test_kept_pieces_don_t_change_results(paths, monkeypatch):
    """Batches after others, with few kept pieces, give what they give alone."""
    texts = [t for (t,) in duckdb.execute(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()] + HOSTILE
    a, b = token_alignment.byte_level(paths[0]), token_alignment.piece_level(paths[1])
    writer = token_alignment.GroupText(51_000)
    monkeypatch.setattr(token_alignment, "KEPT", 500)
    held = token_alignment.Encoder(a, b)
    for k in range(0, len(texts), 40):
        part = pa.array(texts[k : k + 40], pa.string())
        assert token_alignment.aligned(part, held, writer, 32_000)["groups_sha256"] == token_alignment.aligned(part, token_alignment.Encoder(a, b), writer, 32_000)["groups_sha256"]
    assert len(held.known) == 500


def test_very_long_texts(spark, paths):
    long = "client_id=abc token=abcdefgh " + "lorem ipsum dolor " * 60_000 + "AKIA" + "Q" * 16
    d = docs(spark, [long, "x"])
    row = secret_links.secret_spans(d).where("doc_id = 0").first()
    assert (row.n_assign, row.n_access) == (1, 1) and row.spans.endswith(f"access:{len(long) - 20}:{len(long)}") and row.spans.startswith("identifier:0:13")
    row = token_alignment.token_alignment(d, *paths).where("doc_id = 0").first()
    assert row.n_links >= max(row.n_a, row.n_b) > 180_000 and len(row.groups_sha256) == 64

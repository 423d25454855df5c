"""Conversation repair, secret scan and Merkle manifest: awkward rows, and brute force by other means."""

import base64
import hashlib
import heapq
import random
import re
import string
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from groundhold.llm import conversation_repair, merkle, queries, secret_scan

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
EMPTY = hashlib.sha256(b"").hexdigest()
TALK = "conv_id long, turn long, role string, text string, conv string, block long, place long, audit string, code string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------------------------------------ conversation repair


def cheapest(rows):
    """(cost, audit, repaired rows) by a search over (rows read, roles written), cheapest first, then smallest letters."""
    faults, seen = [], set()
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)

    def fits(written, whole):
        return re.fullmatch("(s?(ua)+)?" if whole else "(s?(ua)*u?)?", written) is not None

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, written, made = heapq.heappop(heap)
        state = at, written[-1:] + ("" if len(written) > 1 else "<")
        if at == len(rows) and fits(written, True):
            return cost, audit, list(made), faults
        if state in done:
            continue
        done.add(state)
        moves = [(3, "I", role[0], (role, ""), 0) for role in ("user", "assistant")]
        if at < len(rows):
            (role, text), fault = rows[at], faults[at]
            extra = 3 if fault == "t" else 0
            moves.append((4, "D", "", None, 1))
            if fault not in ("b", "d"):
                moves.append((extra, "K", role[:1], (role, text), 1))
                moves += [(3 + extra, "R", r[0], (r, text), 1) for r in ("user", "assistant")]
        for price, letter, initial, row, step in moves:
            if letter == "D" or (initial and fits(written + initial, False)):
                heapq.heappush(heap, (cost + price, audit + letter, at + step, written + initial, made + ((row,) if row else ())))
    raise AssertionError("every conversation can be repaired")


def talks(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "k", 5, 5, "z", "s") for c, t, r, x in rows], TALK)


def audited(spark, rows):
    table = talks(spark, rows)
    found = conversation_repair.audits(table)
    made = conversation_repair.repaired(table, found)
    digests = {r.conv: r.repaired_sha256 for r in conversation_repair.text_digests(made).collect()}
    return {r.conv: r for r in found.collect()}, digests, made


def test_repairs_are_the_cheapest(spark):
    rng, rows, plain = random.Random(3), [], {}
    for c in range(150):
        own = []
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", " ", ""])
            own.append((role, rng.choice([f"a{t}.", f"b{t}", f"c{t}! ", "same.", "", " \n", f"d{t}?\x0b", "é…"])))
        plain[c] = own
        rows += [(c, t, role, text) for t, (role, text) in enumerate(own)]
    found, digests, made = audited(spark, rows)
    for c, own in plain.items():
        cost, audit, kept, faults = cheapest(own)
        r = found[c]
        assert (r.cost, r.audit) == (cost, audit), own
        assert digests.get(c, EMPTY) == sha("\n".join(f"{role}:{text}" for role, text in kept))
        assert (r.blank, r.duplicate, r.truncated) == tuple(faults.count(f) for f in "bdt")
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(own, own[1:])]
        assert r.illegal == sum(p not in ("su", "ua", "au") for p in pairs) and r.gaps == 0
    assert [r.place for r in made.filter("conv = 0").collect()] == list(range(made.filter("conv = 0").count()))


def test_a_long_conversation_in_many_blocks(spark):
    """Blocks walked one by one agree with one walk over the whole, and rows of one turn are split."""
    rng = random.Random(5)
    rows = [(1, t // 3, rng.choice(["user", "assistant"]), f"{t}{rng.choice(['.', '.', '!', ''])}") for t in range(4000)]
    rows += [(2, 7, "user", "same.")] * 300 + [(None, None, None, None)] * 3
    found, digests, _ = audited(spark, rows)
    order = sorted(rows[:4000], key=lambda r: (r[1], hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
    codes = "".join(r[2][0] if r[3][-1] in ".!?" else r[2][0].upper() for r in order)
    letters, _ = conversation_repair.walk(codes, conversation_repair.END, True)
    assert found[1].audit == letters[0] and found[1].cost == conversation_repair.vectors(codes, conversation_repair.END)[0][0]
    assert (found[1].gaps, found[2].gaps, found[2].duplicate) == (0, 0, 299)
    assert (found[2].cost, found[2].audit) == (4 * 299 + 3, "K" + "D" * 299 + "I")
    assert (found[None].blank, found[None].audit, found[None].illegal, found[None].gaps) == (3, "DDD", 2, 0)
    assert digests[2] == sha("user:same.\nassistant:") and None not in digests


def test_awkward_conversations(spark):
    rows = [(1, None, "user", "b."), (1, 5, "assistant", "c."), (1, 9, None, "d."), (2, 3, "user", None), (3, 1, "", "x" * 2_000_000)]
    found, digests, _ = audited(spark, rows)
    assert (found[1].gaps, found[1].audit, found[1].cost, found[1].illegal) == (3, "KKD", 4, 1)
    assert (found[2].audit, found[2].blank) == ("D", 1)
    assert (found[3].audit, found[3].cost, found[3].truncated) == ("D", 4, 1)
    assert set(digests) == {1}
    assert conversation_repair.audits(talks(spark, rows).limit(0)).isEmpty()


def test_damage(spark):
    table = talks(spark, [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(5)] + [(None, None, None, None)])
    got: dict = {}
    for r in queries.damaged(table).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c in range(40):
        for t in range(5):
            hit = zlib.crc32(f"{c}:{t}".encode()) % 20
            sound = ("assistant", "One. Two!")
            kinds = {0: None, 1: [("assistant", "")], 2: [("assistant", "One Two")], 3: [sound, sound], 4: [("user", "One. Two!")]}
            assert got.get((c, t)) == kinds.get(hit, [sound])
    assert got[None, None] == [(" ", " ")] and zlib.crc32(b" : ") % 20 > 4


# ------------------------------------------------------------------------------------------------ secret scan


def scanned(text):
    """Base spans by a walk over the characters."""
    spans, low = [], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    at, value = 0, set(string.ascii_letters + string.digits + "+/_.=-")
    while at < len(text):
        word = next((w for w in ("password", "passwd", "secret", "token", "api_key", "apikey") if low.startswith(w, at)), None)
        if word:
            i = at + len(word) + (text[at + len(word) : at + len(word) + 1] in ("'", '"') and at + len(word) < len(text))
            while text[i : i + 1] == " ":
                i += 1
            if text[i : i + 1] and text[i] in ":=":
                i += 1
                while text[i : i + 1] == " ":
                    i += 1
                i += text[i : i + 1] in ("'", '"') and i < len(text)
                end = i
                while end < len(text) and text[end] in value:
                    end += 1
                if end > i:
                    spans += [(at, 0, end)] if end - i >= 12 else []
                    at = end
                    continue
        at += 1
    for kind, head, chars, least in ((1, "AKIA", set(string.ascii_uppercase + string.digits), 18), (2, "", set("0123456789abcdef"), 16)):
        at = 0
        while at < len(text):
            end = at + len(head) if text.startswith(head, at) else at
            while (end > at or not head) and end < len(text) and text[end] in chars:
                end += 1
            if end > at + len(head):
                spans += [(at, kind, end)] if end - at >= least else []
                at = end
            else:
                at += 1
    return sorted(spans)


def test_base_spans_against_a_walk():
    rng = random.Random(7)
    parts = ["password", "PassWD", "secret", "token", "api_key", "apikey", "API", "=", ":", " ", "  ", '"', "'", "é", "ſecret", "toKen",
             "AKIA", "AKIAAKIA", "ABCDEFGH1234", "0123456789abcdef", "deadbeef", "x", "Zz9+/_.=-", "\n", "abcdefghijkl"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert sorted(secret_scan.base_spans(text)) == scanned(text), text


def test_random_runs():
    encode = secret_scan.encoder(RANKS)
    rng = random.Random(9)
    found = 0
    for alphabet in (string.ascii_letters + string.digits, string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits):
        found += sum(secret_scan.is_random("".join(rng.choice(alphabet) for _ in range(32)), encode) for _ in range(300))
    assert found >= 0.98 * 900
    known = [hashlib.new(h, b"x").hexdigest() for h in ("md5", "sha1", "sha224", "sha256", "sha384", "sha512")]
    known += [known[0].upper(), "123e4567-e89b-12d3-a456-426614174000", "2024-01-01-12-30-45-000", "4028005252517056000000"]
    words = ["AbstractSingletonProxyFactoryBean", "get_user_account_by_id", "Donaudampfschifffahrtsgesellschaft", "/usr/local/share/doc/packages",
             "antidisestablishmentarianism", "----------------------------", "http_proxy_connect_timeout_ms", "a" * 9000]
    assert not any(secret_scan.is_random(run, encode) for run in known + words)
    assert secret_scan.is_random("".join(rng.choice(string.ascii_letters + string.digits) for _ in range(50_000)), encode)


def test_secret_spans_and_redaction(spark):
    key = base64.b64encode(bytes(random.Random(2).randrange(256) for _ in range(30))).decode()
    texts = [None, "", " \n", f"é key {key} end", f"token = '{key}'; x", "plain words only", "plain words only", "x " * 200_000 + key]
    rows = [(None if i == 5 else i, t, "k", 5, 5) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, kind string, start long, spans long")
    found = {(r.id, r.text): [tuple(s) for s in r.spans] for r in secret_scan.secret_spans(table, RANKS, keep_text=True).collect()}
    assert len(found) == len(texts)
    assert found[3, texts[3]] == [("random", 6, 46)] and found[7, texts[7]] == [("random", 400_000, 400_040)]
    assert found[4, texts[4]] == [("assign", 0, 49), ("random", 9, 49)]
    assert all(found[i, texts[i]] == [] for i in (0, 1, 2, 6)) and found[None, texts[5]] == []
    left = {r.id: (r.n_spans, r.text) for r in secret_scan.redacted(table, RANKS).collect()}
    assert left[3] == (1, "é key [secret] end") and left[4] == (2, "[secret]'; x") and left[0] == (0, None)
    assert secret_scan.secret_spans(table.limit(0), RANKS).isEmpty()


def test_secret_query_against_the_walk(spark):
    """Whole texts of the table; the added spans by a token count of every maximal run."""
    encode = secret_scan.encoder(RANKS)
    table = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op12_secret_scan(spark, SF).collect()
    assert len(rows) == len(table)
    for r in rows:
        base = scanned(table[r.doc_id])
        named = [f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == sha(",".join(named)) and (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(k == i for _, k, _ in base) for i in range(3)
        )
        added = [s for s in r.spans.split(",") if s.startswith("random")]
        assert sorted(named + added) == sorted(filter(None, r.spans.split(",")))
        for span in added:
            run = table[r.doc_id][slice(*map(int, span.split(":")[1:]))]
            assert len(run) >= 20 and len(run) <= 2 * len(encode(run))


# ------------------------------------------------------------------------------------------------ Merkle manifest


def tree(nodes, fanout):
    """The root, and per leaf its siblings by level as (before, after)."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for leaf, place in enumerate(places):
            run, slot = runs[place // fanout], place % fanout
            paths[leaf].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            places[leaf] = place // fanout
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], paths


def brute(rows, fanout):
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops = {g: tree([x[2] for x in sorted(groups[g])], fanout) for g in order}
    root, upper = tree([tops[g][0] for g in order], fanout)
    out = []
    for g, above in zip(order, upper):
        for (has, i, digest), path in zip(sorted(groups[g]), tops[g][1]):
            out.append((i if has else None, digest, tops[g][0], root, tuple(path + above)))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, place long, part string, run long, s0 string"


@pytest.mark.parametrize(("fanout", "levels"), [(2, 4), (2, 1), (3, 2), (5, 1)])
def test_manifest_against_a_tree(spark, fanout, levels):
    rows = [(i, f"s{i % 3}", "en" if i % 4 else "é", i, f"text {i} é") for i in range(90)]
    rows += [(200 + i, None, "de", None, None) for i in range(16)] + [(500, "", "", 0, ""), (None, None, None, None, None)]
    rows += [(7, "s", "fr", 1, "same")] * 5 + [(None, "s", "fr", 1, "x"), (3, "s", "fr", 1, "long " * 100_000)]
    table = spark.createDataFrame([(*r, "d", 9, "p", 9, "s") for r in rows], SCHEMA).repartition(3)
    found = merkle.manifest(table, fanout=fanout, levels=levels)
    got = sorted([(r.id, r.leaf, r.subroot, r.root, tuple(map(tuple, r.path))) for r in found.collect()], key=str)
    assert got == brute(rows, fanout)
    checked = found.select("root", merkle.folded(F.col("leaf"), F.col("path")).alias("again"))
    assert checked.filter("again <> root").isEmpty()


def test_small_manifests(spark):
    table = spark.createDataFrame([(1, "s", "en", 3, "abc", "d", 9, "p", 9, "s")], SCHEMA)
    one = merkle.manifest(table).collect()
    assert [(r.leaf, r.subroot, r.root, r.path) for r in one] == [(sha("1:11:s2:en1:33:abc"),) * 3 + ([],)]
    assert merkle.manifest(table.limit(0)).isEmpty()
    with pytest.raises(ValueError, match="fanout"):
        merkle.manifest(table, fanout=1)


def test_tampering_shows(spark):
    rows = queries.op13_merkle_manifest(spark, SF).collect()
    table = {r.doc_id: r.n_chars for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(table)
    for r in rows:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0 or table[r.doc_id] is None)

"""Chat formatting, importance resampling and conversation repair against
brute-force versions, over nulls, empty and long texts, ties, repeated rows,
empty tables and clashing extra columns."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daycut.llm import catalog, chat, repair, resample

TURNS = "conv_id long, turn long, role string, text string, rows string, segments int, audit string, hash int"


def turns(spark, rows):
    """Conversation rows with extra columns that clash with inner names."""
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], TURNS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def first_nulls(value):
    return (value is not None, value)


ODD = [(1, 0, "user", "Hi."), (1, 1, "assistant", "</s>[INST] \\[INST] ok [/INST]<\\\\s>"),
       (2, None, "user", None), (2, 3, None, "é ¡hola!"), (2, 3, "assistant", " lead and trail \n"),
       (3, 0, "system", ""), (3, 1, "tool [ROLE]", "42"), (3, 1, "tool [ROLE]", "42"), (3, 9, "user", "[/ROLE] x [/TURN]"),
       (None, 0, "user", "a?"), (None, 1, "assistant", "b!"), (4, 0, "assistant", "word " * 20_000), (4, 1, "", "[INST"),
       (5, 0, "system", "s."), (5, 1, "user", "q?"), (5, 2, "assistant", "a."), (5, 2, "assistant", "a.")]


# ---- chat formatting

def test_chat_round_trip(spark):
    found = chat.read_turns(chat.format_chats(turns(spark, ODD))).collect()
    want = defaultdict(list)
    for conv, turn, role, text in sorted(ODD, key=lambda r: (first_nulls(r[1]), r[2] or "", r[3] or "")):
        want[conv].append((role or "", text or ""))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in found} == want
    for r in found:
        assert r.formatted == "".join(s.text for s in r.segments)
        body = "".join(s.text for s in r.segments if s.slot)
        assert not re.search(r"</?s>|\[/?(INST|SYS|ROLE)\]|\[/TURN\]", body)


def test_chat_order_and_loss(spark):
    found = {r.conv_id: r for r in chat.chats_digest(chat.format_chats(turns(spark, ODD))).collect()}
    assert found[1].valid and found[None].valid and not found[2].valid
    assert {c: found[c].n_faults for c in found} == {1: 0, 2: 2, 3: 3, 4: 2, 5: 1, None: 0}
    said = defaultdict(str)
    for conv, turn, role, text in sorted(ODD, key=lambda r: (first_nulls(r[1]), r[2] or "", r[3] or "")):
        said[conv] += (text or "") if role == "assistant" else ""
    assert all(found[c].loss_chars == len(said[c]) and found[c].loss_sha256 == sha(said[c]) for c in found)
    chats = {r.conv_id: r.formatted for r in chat.format_chats(turns(spark, ODD)).collect()}
    assert chats[None] == "<s>[INST] a? [/INST] b!</s>"
    assert all(found[c].formatted_chars == len(chats[c]) for c in found)


def test_chat_empty_table(spark):
    assert chat.chats_digest(chat.format_chats(turns(spark, []))).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["[", "<", "/", "\\", "s>", "INST]", "SYS]", "ROLE]", "/TURN]", " ", "é"]), max_size=9),
                min_size=1, max_size=40))
def test_escape_round_trip(spark, pieces):
    texts = ["".join(p) for p in pieces]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select(
        "text", chat.escape(F.col("text")).alias("safe")).select("text", "safe", chat.unescape(F.col("safe")).alias("back"))
    for r in rows.collect():
        assert r.back == r.text and not any(c in r.safe for c in chat.INSTRUCTION.control)


def test_other_template(spark):
    marked = chat.Template(
        begin="", turns={"user": (chat.Part("<u> "), chat.Part(slot="text"), chat.Part("</u>")),
                         "assistant": (chat.Part("<a>"), chat.Part(slot="text", loss=True), chat.Part("</a>", loss=True))},
        other=(chat.Part("<r>"), chat.Part(slot="role"), chat.Part("</r>"), chat.Part(slot="text"), chat.Part("</t>")),
        control=("<u>", "</u>", "<a>", "</a>", "<r>", "</r>", "</t>"),
        follows={"": ("user",), "user": ("assistant",), "assistant": ("user",)}, final=("assistant", "user"))
    rows = chat.read_turns(chat.format_chats(turns(spark, ODD), marked), marked).collect()
    assert {r.conv_id: len(r.turns) for r in rows} == Counter(r[0] for r in ODD)
    got = next(r for r in rows if r.conv_id == 1)
    assert [tuple(t) for t in got.turns] == [("user", "Hi."), ("assistant", ODD[1][3])]
    assert got.formatted.startswith("<u> Hi.</u><a>") and got.valid


# ---- importance resampling

DOCS = "doc_id long, text string, weight string, score string, rank string, id string, part int, at int"
_WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features(text, n):
    w = words(text)
    return [" ".join(w[i:i + g]) for g in range(1, n + 1) for i in range(len(w) - g + 1)]


def brute_resample(docs, target, n, buckets, seed, min_words, percent):
    count = lambda texts: Counter(zlib.crc32(f.encode()) % buckets for x in texts for f in features(x, n))
    s, t = count(x for _, x in docs), count(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (t_all * 0 + s_all + buckets) / ((s[b] + 1.0) * (t_all + buckets))))
            for b in range(buckets)]
    rows = []
    for doc, text in docs:
        found = features(text, n)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found)
        h = int(sha(f"{seed}:{'' if doc is None else doc}")[:8], 16)
        rows.append((doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words(text))))
    fit = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    drawn = fit[:percent * len(fit) // 100]
    rest = Counter(r[:4] for r in rows) - Counter(r[:4] for r in drawn)
    return sorted([(*r[:4], i) for i, r in enumerate(drawn, 1)] + [(*r, None) for r in rest.elements()], key=str)


def prose(rng, n):
    return " ".join(rng.choice(["Wort", "É", "x9", "thé", "THE", "end.", "日本", "a-b", "q" * 70]) + str(rng.randrange(30)) for _ in range(n))


@pytest.mark.parametrize("n,percent", [(1, 10), (2, 35), (3, 100), (1, 0)])
def test_resample(spark, n, percent):
    rng = random.Random(n)
    docs = [(i, prose(rng, rng.choice([0, 3, 20, 40, 200]))) for i in range(150)]
    docs += [(900, None), (901, ""), (902, "?! --"), (None, prose(rng, 50)), (7, docs[7][1]), (7, docs[7][1]), (8, prose(rng, 60)),
             (903, "z" * 300_000 + " " + prose(rng, 3000))]
    docs += [(950, "Ab cd " * 30)] * 40                     # repeated rows tie in every column
    target = [prose(rng, 80), None, "", "É1 x9"]
    frame = spark.createDataFrame([(*d, "a", "b", "c", "d", 1, 2) for d in docs], DOCS).repartition(5)
    bench = spark.createDataFrame([(x,) for x in target], "text string")
    found = resample.resample(frame, bench, n=n, buckets=500, percent=percent)
    got = sorted([(r.id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()], key=str)
    assert got == brute_resample(docs, target, n, 500, 2024, 20, percent)


def test_resample_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert resample.resample(none, none).count() == 0
    assert resample.resample(none, some).count() == 0
    assert sorted(r.weight for r in resample.resample(some, none).collect())[0] is not None


def test_cutoff_widens_its_bracket(spark):
    """A coarse sketch brackets the wrong place; exact counts widen it."""
    rng = random.Random(3)
    scores = [rng.choice([5, 5, 5, rng.randrange(10_000)]) for _ in range(4000)]
    rows = spark.createDataFrame([(i, s, 0) for i, s in enumerate(scores)], "id long, score long, n_features long")
    order = sorted((-s, i) for i, s in enumerate(scores))
    for take in (1, 7, 399, 1000, 3999, 4000):
        for accuracy in (2, 50, 10_000):
            row = resample.cutoff(rows, take, len(scores), accuracy)
            assert (-row.score, row.id) == order[take - 1]
    assert resample.cutoff(rows, 0, len(scores)) is None


def test_only_the_bracket_is_sorted(spark):
    rows = spark.range(50_000).select("id", F.pmod(F.xxhash64("id"), F.lit(1_000_000)).alias("score"), F.lit(1).alias("n_features"))
    sizes = []

    def ranked(part):
        sizes.append(part.count())
        return resample.rank_rows(part)

    assert resample.cutoff(rows, 5000, 50_000, 10_000, ranked) is not None
    assert len(sizes) == 1 and sizes[0] < 200


# ---- conversation repair

def edits(rows):
    """Every row as (initial, gone, truncated)."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = 1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def brute_repair(rows):
    """Cheapest audit by search over whole edit strings: (cost, audit, turns)."""
    import heapq
    state = edits(rows)
    best = {}
    heap = [(0, "", 0, "", ())]
    while heap:
        cost, audit, at, roles, out = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, list(out)
        key = (at, roles[-1:], roles[:1] == "s")
        if best.setdefault(key, cost) < cost:
            continue
        follow = lambda r: re.fullmatch("s?(ua)*u?", roles + r) is not None
        for r, name in (("u", "user"), ("a", "assistant")):
            if follow(r):
                heapq.heappush(heap, (cost + 3, audit + "I", at, roles + r, out + ((name, ""),)))
        if at < len(rows):
            (role, text), (initial, fault) = rows[at], state[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, roles, out))
            if fault not in (1, 2):
                more = 3 if fault == 3 else 0
                if initial and initial in "sua" and follow(initial):
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, roles + initial, out + ((role, text),)))
                for r, name in (("u", "user"), ("a", "assistant")):
                    if follow(r):
                        heapq.heappush(heap, (cost + more + 3, audit + "R", at + 1, roles + r, out + ((name, text),)))


def brute_facts(rows):
    faults = edits([(r, t) for _, r, t in rows])
    nums = [t for t, _, _ in rows if t is not None]
    gaps = max(nums) - min(nums) + 1 - len(set(nums)) if nums else 0
    count = Counter(f for _, f in faults)
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(faults))
    return gaps, count[1], count[2], count[3], illegal


def random_conversations(seed, n):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randrange(1, 8)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Why", "", " \t", "Yes. \n", None, f"t{turn}.", f"u{turn}", "É?"])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]), role, text))
    return rows


def by_conversation(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append((turn, " " if role is None else role, " " if text is None else text))
    return {c: sorted(r, key=lambda x: ((x[0] is not None, x[0] or 0), x[1], hashlib.sha256(x[2].encode()).digest()))
            for c, r in out.items()}


def check_repair(spark, rows):
    plans, repaired = repair.repair_conversations(turns(spark, rows))
    got = {r.conv_id: r for r in repair.repairs_digest(plans, repaired).collect()}
    left = defaultdict(list)
    for r in sorted(repaired.collect(), key=lambda r: r.place):
        left[r.conv_id].append((r.role, r.text))
    want = by_conversation(rows)
    assert set(got) == set(want)
    for conv, said in want.items():
        r = got[conv]
        cost, audit, out = brute_repair([(role, text) for _, role, text in said])
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal) == brute_facts(said), conv
        assert (r.cost, r.audit) == (cost, audit), (conv, said)
        assert left[conv] == out and r.repaired_sha256 == sha("\n".join(f"{a}:{b}" for a, b in out))


def test_repair(spark):
    check_repair(spark, random_conversations(1, 250) + [(c and c + 1000, *r) for c, *r in ODD])


def test_repair_many_audits(spark, monkeypatch):
    """The salted join, for audits beyond what is sent to every task."""
    monkeypatch.setattr(repair, "SENT_BYTES", 0)
    check_repair(spark, random_conversations(2, 60) + [(500 + i, 0, "user", "Yes.") for i in range(200)])


def test_repair_long_conversation(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"turn {i}.") for i in range(20_000)]
    rows += [(2, 0, "user", "x" * 300_000)]
    plans, repaired = repair.repair_conversations(turns(spark, rows))
    got = {r.conv_id: (r.cost, len(r.audit)) for r in plans.collect()}
    assert got == {1: (0, 20_000), 2: (4, 1)}
    assert repaired.count() == 20_000


def test_repair_empty_table(spark):
    plans, repaired = repair.repair_conversations(turns(spark, []))
    assert plans.count() == 0 and repaired.count() == 0
    assert repair.repairs_digest(plans, repaired).count() == 0


def test_automaton_shares_suffixes(spark):
    """Each distinct suffix is worked out once (one partition)."""
    rng = random.Random(5)
    words = ["".join(rng.choice("suaxUA") for _ in range(rng.randrange(0, 9))) for _ in range(400)]
    rows = spark.createDataFrame([(w,) for w in words], "signature string").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        nodes = repair.audits(rows).agg(F.sum("nodes")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert nodes == len({w[i:] for w in words for i in range(len(w))})


def test_damage_on_whole_table(spark):
    """The registered query against a plain version of damage and repair."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    hurt = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if code:
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            hurt += [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    want = {c: brute_repair([(r, t) for _, r, t in said])[:2] for c, said in by_conversation(hurt).items()}
    got = {r.conv_id: (r.cost, r.audit) for r in catalog.op13_conversation_repair(spark, "/root/testdata/sf0.001").collect()}
    assert got == {c: want.get(c, (0, "")) for c in {r[0] for r in rows}}

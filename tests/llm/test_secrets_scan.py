"""Secret scan: base spans against the plain rules, added spans on planted secrets."""

import hashlib
import random
import re
import string

from fleetlife.llm import secrets_scan


def plain_base(text):
    found = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(found)]


def made(n=300, seed=3):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice(string.ascii_lowercase + "éß") for _ in range(pick.randrange(1, 14)))
    token = lambda n, signs=string.ascii_letters + string.digits: "".join(pick.choice(signs) for _ in range(n))
    rows, planted = [], {}
    for i in range(n):
        words = [word() for _ in range(60)]
        kind = pick.choice(["", "", "assign", "short", "access", "hex", "other"])
        part = {"": "plain", "assign": f'{pick.choice(["Password", "API_KEY", "apikey", "toKen"])}{pick.choice(["", chr(34)])} {pick.choice(":=")} "{token(30)}"', "short": "token=abc", "access": "AKIA" + token(16, string.ascii_uppercase + string.digits), "hex": token(32, "0123456789abcdef"), "other": "key " + token(36)}[kind]
        words[30] = part
        rows.append((i, " ".join(words)))
        if kind == "other":
            planted[i] = part.split()[1]
    return rows, planted


def test_base_spans_and_digest(spark):
    rows, _ = made()
    rows += [(900, None), (901, ""), (902, "ſecret=abcdefgh to\u212aen=abcdefgh 🙂 token=abcdefgh"), (903, "AKIAAKIA1 " + "a" * 23 + "g" + "b" * 24), (903, "token=" + "f" * 40), (904, "secret= 'x' secret : abcdef")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "doc_id", "1 as spans", "2 as found")
    got = secrets_scan.digest(secrets_scan.find_secrets(docs)).collect()
    assert len(got) == len(rows)
    wanted = []
    for doc_id, text in rows:
        base = plain_base(text or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        wanted.append((doc_id, *(sum(k == kind for k, _, _ in base) for kind in ("assign", "access", "hex")), hashlib.sha256(joined.encode()).hexdigest()))
        assert any(set(joined.split(",")) - {""} <= set(r.spans.split(",")) for r in got if r.doc_id == doc_id)
    assert sorted(tuple(r)[:5] for r in got) == sorted(wanted)


def test_network_adds_planted_secrets_and_leaves_words(spark):
    rows, planted = made()
    got = secrets_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    added = {(r.doc_id, r.text[s.start : s.finish]) for r in got for s in r.spans if s.kind == "network"}
    wanted = set(planted.items())
    assert len(added & wanted) >= 0.8 * len(wanted)
    assert added <= wanted


def test_secrets_behind_a_long_start_and_around_a_base_span(spark):
    rows, _ = made()
    pick = random.Random(5)
    secret = "".join(pick.choice(string.ascii_letters + string.digits) for _ in range(36))
    run = "".join(pick.choice("0123456789abcdef") for _ in range(24))
    late, around = "plain-words-in-a-long-path-of-names/" + secret, secret[:18] + "Z" + run + "Z" + secret[18:]
    rows += [(900, f"see {late} there"), (901, f"key {around} there")]
    got = secrets_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    added = {(r.doc_id, r.text[s.start : s.finish]) for r in got for s in r.spans if s.kind == "network"}
    assert {(900, late), (901, around)} <= added
    assert secrets_scan.candidates(around, secrets_scan.base_spans(around)) == [(0, len(around))]
    assert secrets_scan.candidates(run, secrets_scan.base_spans(run)) == []


def test_stretches_cover_the_candidate():
    for size in (16, 32, 33, 48, 49, 64, 100):
        at = secrets_scan.stretches(5, 5 + size)
        assert set(range(5, 5 + size)) <= {i for a in at for i in range(a, a + secrets_scan.INSIDE)} and at[0] == 5


def test_recall_wins():
    network, rng = secrets_scan.Convolution(), secrets_scan.np.random.default_rng(2)
    x, y = rng.integers(0, secrets_scan.CLASSES, (400, secrets_scan.WIDTH)).astype("uint8"), secrets_scan.np.arange(400) % 2
    network.calibrate(x, y, 0.98, 0.01)
    assert (network.score(x[y > 0]) >= network.threshold).mean() >= 0.98 and network.false_rate > 0.01


def test_redaction(spark):
    rows = [(1, "a token=abcdefgh b"), (2, "token=" + "a" * 30), (3, None), (4, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "7 as n")
    found = secrets_scan.find_secrets(docs, carried=("n",))
    got = sorted(tuple(r) for r in secrets_scan.redact(found).collect())
    assert got == [(1, "a [SECRET] b", 7), (2, "[SECRET]", 7), (3, None, 7), (4, "clean", 7)]
    assert secrets_scan.find_secrets(docs.limit(0)).collect() == []


def test_every_labelled_example_is_learned_from(spark, monkeypatch):
    """More examples than any sample held: all are labelled, dealt to shards once, and reruns agree."""
    pick = random.Random(6)
    rows = [(i, f"{''.join(pick.choices(string.ascii_lowercase, k=12))} token={''.join(pick.choices(string.ascii_lowercase + string.digits, k=20))} more") for i in range(2_500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = secrets_scan.labelled_findings(docs)
    assert found.where("found = 1").count() == 2 * len(rows)
    monkeypatch.setattr(secrets_scan, "FEW", 1_000)
    monkeypatch.setattr(secrets_scan, "SHARD", 1_500)
    monkeypatch.setattr(secrets_scan, "ROUNDS", 2)
    one, two = (secrets_scan.fit(f, 0.98, 0.01) for f in (found, found.repartition(3)))
    assert one.threshold == two.threshold and (one.filters == two.filters).all()
    kept = secrets_scan._examples(found.where("found = 1").limit(500).toArrow())[0]
    assert (one.score(kept) >= one.threshold).mean() > 0.9


def test_redaction_takes_no_python_step(spark):
    rows = [
        (1, "aß😀 key=abc def", [("assign", 4, 11, 1.0), ("hex", 8, 11, 1.0), ("network", 11, 12, 0.9)]),
        (2, "plain", []),
        (3, None, []),
        (4, "abc", [("hex", 0, 3, 1.0)]),
    ]
    found = spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<kind:string,start:int,finish:int,score:double>>")
    clean = secrets_scan.redact(found, "*")
    assert clean.columns == ["doc_id", "text"]
    assert {r.doc_id: r.text for r in clean.collect()} == {1: "aß😀 **def", 2: "plain", 3: None, 4: "*"}
    assert "InArrow" not in clean._jdf.queryExecution().executedPlan().toString()

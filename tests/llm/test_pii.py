import hashlib
import random
import re

from clickfeat.llm import common, pii
from conftest import SF_SMALL
from util import edge_rows, frame, nulls_last

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    """kind -> spans."""
    only = lambda m: re.sub("[^0-9]", "", m.group())
    out = {"email": [m.span() for m in EMAIL.finditer(text)] if "@" in text else [],
           "ip": [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))] if "." in text else [],
           "card": [m.span() for m in CARD.finditer(text) if 12 <= len(only(m)) <= 19 and luhn(only(m))],
           "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(only(m)) <= 15]}
    rows = sorted((s, i, e, k) for i, (k, v) in enumerate(out.items()) for s, e in v)
    return [len(v) for v in out.values()], ",".join(f"{k}:{s}:{e}" for s, _, e, k in rows)


def check(spark, rows):
    out = pii.sanitise(frame(spark, rows)).collect()
    got = sorted((nulls_last(r.doc_id), [r.n_email, r.n_ip, r.n_card, r.n_phone], r.base) for r in out)
    assert got == sorted((nulls_last(r[0]), *brute(r[1] or "")) for r in rows)
    for r in out:
        assert set(r.base.split(",")) <= set(r.spans.split(",")) or not r.base
    return out


def odd(n=500):
    rng = random.Random(6)
    parts = ["a@b.c", "x.y%z@w-1.example.com", "@", ".", "1.2.3.4", "255.255.255.255", "256.1.1.1", "1.2.3.4.5.6.7.8", "0255.01.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (555) 123-4567", "+12", "+1 2", "++49 30 1234567", "a", "_", "-", " ", "é", "\U0001F600", "1", "99", "\n", "a@b", "c.d@e.f_g@h.i", "5500 0000 0000 0004", "  "]
    return [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(n)]


def test_base_spans(spark):
    check(spark, edge_rows() + [(10_000 + i, t) for i, t in odd()])


def test_documents(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in common.documents(spark, SF_SMALL).collect()]
    check(spark, rows)


def test_long_runs_stay_linear(spark):
    rows = [(1, "a" * 200_000), (2, "1" * 200_000), (3, "1." * 100_000), (4, "a.b" * 60_000 + "@"), (5, "+1" + " " * 100_000), (6, "1 " * 100_000)]
    assert all(r.spans == "" or r.doc_id == 3 for r in pii.sanitise(frame(spark, rows)).collect())


def secrets_of_one_person(n=400):
    rng = random.Random(9)
    plain = lambda k: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(k))
    rows = [(i, plain(20) + " the meeting") for i in range(n)]
    for i in range(6):                                 # one address, each time beside the same name and a common word
        rows[i * 10] = (i * 10, f"{plain(12)} the Zaphodson meeting wrote from z.b{''}@heart.example.com {plain(12)}")
    rows[5] = (5, plain(4) + " Zaphodson came " + plain(3))
    return rows


def test_disclosing_terms_are_generalised(spark):
    rows = secrets_of_one_person()
    out = {r.doc_id: r for r in pii.sanitise(frame(spark, rows)).collect()}
    text = dict(rows)
    for i in (0, 10, 20, 30, 40, 50, 5):
        at = text[i].index("Zaphodson")
        assert f"term:{at}:{at + 9}" in out[i].spans.split(",")
        assert "Zaphodson" not in out[i].sanitised and "[NAME]" in out[i].sanitised
        assert i == 5 or " the " in out[i].sanitised
    assert "[EMAIL]" in out[0].sanitised and "@" not in out[0].sanitised
    assert all(r.n_term == 0 and r.sanitised is None for i, r in out.items() if "Zaphodson" not in text[i])
    # the common word beside the address tells nothing
    assert all("meeting" in r.sanitised for r in out.values() if r.sanitised and r.doc_id != 5)


def test_a_name_that_is_part_of_the_address_is_generalised(spark):
    rows = [(i, t.replace("Zaphodson", "Smith").replace("z.b@heart", "john.smith@acme").replace(" the ", " mail ")) for i, t in secrets_of_one_person()]
    out = {r.doc_id: r for r in pii.sanitise(frame(spark, rows)).collect()}
    for i in (0, 10, 20, 30, 40, 50, 5):
        at = dict(rows)[i].index("Smith")
        assert f"term:{at}:{at + 5}" in out[i].spans.split(",")
        assert "Smith" not in out[i].sanitised and "[NAME]" in out[i].sanitised
    assert " mail " in out[0].sanitised                # common, so it tells nothing, though the entity is listed as email


def contexts(text):
    """(entity, words beside it), plainly."""
    words = [(m.group(), *m.span()) for m in re.finditer(r"[^\W_]+", text)]
    out, kinds = [], {}
    for x in filter(None, brute(text)[1].split(",")):
        k, s, e = x.split(":")
        kinds.setdefault(k, []).append((int(s), int(e)))
    for k, v in kinds.items():
        for i, (s, e) in enumerate(v):
            low = max(s - pii.REACH, v[i - 1][1] if i else 0)
            high = min(e + pii.REACH, v[i + 1][0] if i + 1 < len(v) else len(text))
            own = text[s:e]
            own = own.lower() if k in ("email", "ip") else re.sub("[^0-9]", "", own)
            out.append((f"{k}:{own}", sorted(w for w, a, b in words if low <= a and b <= s or e <= a and b <= high)))
    return sorted(out)


def test_contexts_end_at_entities_and_hold_whole_words(spark):
    card = "4111 1111 1111 1111"
    rows = [(1, f"card {card} exp 12/27 holder John Smith"), (2, f"in 2019 Mary paid 30 with {card}, then 1.2.3.4.5 and 10.0.0.1 from 1.2.3.999 to Rome"),
            (3, "x" * 100 + " Anna wrote a@b.example.com and c@d.example.com wrote back " + "abcdefghij " * 10), (4, f"{card} one {card} two {card}three"),
            (5, ("word " * 700 + f"Zoe {card} 77 Jim ") * 5), (6, "call +49 30 1234567 or +12 for Bob\n"), (7, f"{card}\nJohn" + " " * 90), (8, "é\U0001F600 Ünal " * 300 + "a@b.cd tail")]
    rows += [(100 + i, t) for i, t in odd(300)]
    got = {r.doc_id: r.met for r in pii.base_rows(frame(spark, rows)).select("doc_id", "met").collect()}
    for i, t in rows:
        assert sorted((m.e, sorted(x for x in re.split(r"[\W_]+", m.c) if x)) for m in got[i]) == contexts(t), (i, t)
    assert {"holder", "John", "Smith"} <= set(contexts(rows[0][1])[0][1])


def told(spark, rows):
    docs = frame(spark, rows)
    base = common.table(pii.base_rows(docs), "test-base")
    return {(r.entity, r.term): r.share for r in pii.disclosing_terms(docs, base).collect()}


def test_rare_entities_and_exact_counts(spark):
    rows = [(i, "plain words of the meeting") for i in range(1000)]
    rows[0] = (0, "the Onceler meeting at o@once.example.com")                       # met once
    rows[1] = (1, "the Twoson meeting at t@two.example.com")
    rows[2] = (2, "another Twoson paper by t@two.example.com")                       # met twice
    for i in range(100):                                                             # n(e) = n(t) = 40, 12 shared, each with four mentions
        if i < 12:
            rows[100 + i] = (100 + i, f"Sharer{'.' * i} f@four.example.com " * 4)
        elif i < 40:
            rows[100 + i] = (100 + i, f"f@four.example.com {'.' * i}" + " and" * 30)
        elif i < 68:
            rows[100 + i] = (100 + i, "Sharer of the meeting")
    got = told(spark, rows)
    assert got["email:t@two.example.com", "Twoson"] == 1
    assert not any(e == "email:o@once.example.com" for e, _ in got)                  # one meeting is no co-occurrence
    assert not any(t in ("the", "meeting") for _, t in got)
    assert ("email:f@four.example.com", "Sharer") not in got                         # 12 of 40 documents, not 48 of 40
    # fully repeated rows are one document in all counts
    assert told(spark, rows + rows[:500]) == got


def test_copies_of_one_passage_are_one_context(spark):
    rows = [(i, "unique Quuxman wrote from q@q.example.com today") for i in range(30)] + [(100 + i, "other words") for i in range(100)]
    assert all(r.n_term == 0 for r in pii.sanitise(frame(spark, rows)).collect())


def test_planted_names_are_found_and_clean_documents_left_alone(spark):
    """Names beside addresses in three contexts or more, in a corpus of rare words: precision and recall of documents altered by terms."""
    rng = random.Random(17)
    word = lambda: "".join(rng.choice(["an", "er", "th", "st", "ou", "ing", "re", "ha", "ti", "ea"]) for _ in range(rng.randint(2, 4)))
    plain = lambda k: " ".join(word() for _ in range(k))
    rows, holds = [], {}
    for p in range(40):
        name = f"Zq{word()}{p}x".replace("0", "o").translate(str.maketrans("123456789", "bcdfghjkl"))
        for _ in range(rng.randint(3, 6)):
            i = len(rows)
            rows.append((i, f"{plain(30)} {name} wrote from p{p}@mail.example.com {plain(30)}"))
            holds[i] = name
        rows.append((len(rows), f"{plain(20)} {name} {plain(20)}"))
        holds[len(rows) - 1] = name
    for _ in range(300):                               # addresses met once, with whatever stands beside them
        rows.append((len(rows), f"{plain(20)} u{len(rows)}@mail.example.com {plain(20)}"))
    rows += [(len(rows) + k, plain(60)) for k in range(1500)]
    out = {r.doc_id: r for r in pii.sanitise(frame(spark, rows)).collect()}
    altered = {i for i, r in out.items() if r.n_term}
    right = {i for i, name in holds.items() if i in altered and name not in out[i].sanitised}
    assert len(right) >= 0.9 * len(holds) and len(altered & set(holds)) >= 0.9 * len(altered)
    clean = [i for i in out if i not in holds]
    assert sum(out[i].n_term == 0 for i in clean) >= 0.99 * len(clean)


def plain_clean(text, items):
    """items: (start, kind, end) in order."""
    out, at = [], 0
    for s, k, e in items:
        if s >= at:
            own = text[s:e]
            put = pii.KINDS[k].upper() if k < 4 else "NUMBER" if re.search("[0-9]", own) else "NAME" if own[0].isupper() else "..."
            out += [text[at:s], f"[{put}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def test_texts_are_assembled_from_all_their_spans(spark):
    from pyspark.sql import functions as F
    rng = random.Random(12)
    rows = []
    for i in range(60):
        n = rng.choice([0, 5, 300, 5000, 9000])
        text = "".join(rng.choice("ab1 Xé\U0001F600") for _ in range(n))
        some = sorted({(s, rng.randrange(5), min(n, s + rng.randint(1, 40))) for s in (rng.randrange(n) for _ in range(rng.choice([0, 1, 7, 900]))) if s < n}) if n else []
        rows.append((i, text, some))
    df = spark.createDataFrame([(i, t, [dict(s=s, k=k, e=e) for s, k, e in x]) for i, t, x in rows], "i long, t string, items array<struct<s:int,k:int,e:int>>")
    df = common.fixed(df, cut=common.pieces(F.col("t"), pii.REACH))
    got = {r.i: r.c for r in df.select("i", pii.cleaned(F.col("t"), F.col("cut"), F.col("items")).alias("c")).collect()}
    for i, t, some in rows:
        assert got[i] == plain_clean(t, some), i


def test_query_and_empty(spark):
    from clickfeat.llm import queries
    rows = queries.QUERIES["op4_pii"](spark, SF_SMALL).collect()
    want = {r.doc_id: hashlib.sha256(brute(r.text or "")[1].encode()).hexdigest() for r in common.documents(spark, SF_SMALL).collect()}
    assert {r.doc_id: r.base_sha256 for r in rows} == want
    assert pii.sanitise(frame(spark, [])).count() == 0

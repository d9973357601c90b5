import hashlib
import re

from topiclens.llm.pii import digest, personal_spans, sanitise

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    text = text or ""
    out = []
    for k, (name, rx) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        for m in rx.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if name == "ip" else True,
                  "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[name]
            if ok:
                out.append((m.start(), k, m.end(), name))
    out.sort()
    counts = [sum(1 for o in out if o[1] == k) for k in range(4)]
    return counts, ",".join(f"{n}:{s}:{e}" for s, _, e, n in out)


TEXTS = ["mail a.b+c@x-y.co.uk, or 10.0.0.1 now", "a@b.co_foo@d.e x@y z@w..q", "1.2.3.4.5.6.7.8 999.1.1.1 0001.002.3.4",
         "4111 1111 1111 1111 and 4111-1111-1111-1112, 41111111111111111111 4111  1111", "+1 (743) 555-3824 +12 3 +1 2345678901234567890",
         "é漢😀 4785380592391139 😀a@b.cc é", None, "", "+", "x" * 5000 + "@", "9" * 3000, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9 0 1 2 3", "..@a.b.c-@d.e",
         "a@b.c1.2.3.4", "+1-4111 1111 1111 1111", "1.2.3.256 1.2.3.4\n5.6.7.8", "--+49 (0)30 123456", "plain text with no data at all"]


def frame(spark, texts):
    rows = [(t, i, "x") for i, t in enumerate(texts)] + [(TEXTS[0], None, "y"), (TEXTS[0], 0, "y")]
    return spark.createDataFrame(rows, "text string, doc_id long, base string")


def test_base_spans_equal_brute_force(spark):
    for r in digest(personal_spans(frame(spark, TEXTS))).collect():
        counts, spans = brute(TEXTS[r["doc_id"] or 0])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == counts, TEXTS[r["doc_id"] or 0]
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert set(filter(None, spans.split(","))) <= set(r["spans"].split(","))


def test_test_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    got = digest(personal_spans(docs)).collect()
    assert len(got) == len(texts)
    for r in got:
        counts, spans = brute(texts[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == counts
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert bool(spans) or r["spans"] == ""


def disclosure_corpus():
    rows = [f"Report {i}: Zebulon wrote from zeb@corp.example about item {i}." for i in range(5)]
    rows += [f"The report of day {i} was about the weather and item {i}." for i in range(300)]
    return rows + ["Zebulon is not named with an address here."]


def test_disclosing_terms_are_found_only_near_their_entity(spark):
    rows = disclosure_corpus()
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for r in digest(personal_spans(df)).collect():
        text, spans = rows[r["doc_id"]], [s.split(":") for s in r["spans"].split(",") if s]
        terms = {text[int(a):int(b)].lower() for k, a, b in spans if k == "term"}
        assert ("zebulon" in terms) == ("@" in text)
        assert not terms & {"report", "about", "item", "the"}


def test_sanitise(spark):
    rows = disclosure_corpus()
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in sanitise(df).collect()}
    assert "<EMAIL>" in got[0] and "zeb@" not in got[0] and "Zebulon" not in got[0] and got[0].endswith("item 0.")
    assert all(got[i] == t for i, t in enumerate(rows) if "@" not in t)


def test_empty_table(spark):
    assert digest(personal_spans(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


def test_disclosing_terms_change_in_the_whole_text_of_their_documents(spark):
    filler = " The report of day was about the weather and item." * 8
    rows = disclosure_corpus()
    rows[0] += filler + " Then Zebulon left; ZEBULON signed."
    rows += [None, ""]
    df = spark.createDataFrame([(None if i == 1 else i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in sanitise(df).collect()}
    assert "zebulon" not in got[0].lower() and "<EMAIL>" in got[0] and filler in got[0]
    assert "zebulon" not in got[None].lower()  # a null id is a value like others
    spans = {r["doc_id"]: r["spans"] for r in digest(personal_spans(df)).collect()}
    found = {(int(a), int(b)) for k, a, b in (s.split(":") for s in spans[0].split(",")) if k == "term"}
    assert {(m.start(), m.end()) for m in re.finditer("(?i)zebulon", rows[0])} <= found
    assert got[len(rows) - 3] == rows[-3]  # names the person without the address


def marked_terms(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = []
    for r in digest(personal_spans(df)).collect():
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        out.append((r["doc_id"], {rows[r["doc_id"]][int(a):int(b)].lower() for k, a, b in spans if k == "term"}))
    return dict(out)


def test_terms_of_any_script_and_with_digits(spark):
    names = ["Владимир", "Γιώργος", "محمد", "मोहन", "Bo", "AB12345", "ß7"]
    rows = [f"Report {i}: {n} wrote from p{k}@corp.example about it." for k, n in enumerate(names) for i in range(4)]
    rows += [f"小明 用 z@corp.example 写 报告。王小明。{i}" for i in range(4)]
    rows += [f"The report of day {i} was about the weather, it wrote from corp." for i in range(400)]
    got = marked_terms(spark, rows)
    for k, n in enumerate(names):
        assert all(n.lower() in got[4 * k + i] for i in range(4)), n
    assert all("小明" in got[4 * len(names) + i] for i in range(4))
    assert not set().union(*got.values()) & {"report", "about", "it", "from"}


def test_copied_and_single_documents_count(spark):
    copied = "Zebulon wrote from zeb@corp.example about the item."
    rows = [copied] * 50 + ["Quentin wrote from quentin@corp.example about the item."]
    rows += [f"The wrote from about item of day {i}." for i in range(1200)]
    got = marked_terms(spark, rows)
    assert all(got[i] == {"zebulon"} for i in range(50))
    assert not got[50] & {"wrote", "from", "about", "the", "item"}


def test_an_entity_of_one_document_has_terms(spark):
    rows = ["Zebulon wrote from z77@corp.example about the item."] + [f"The wrote from about item of day {i}." for i in range(400)]
    assert marked_terms(spark, rows)[0] == {"zebulon"}

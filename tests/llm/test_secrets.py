import hashlib

from larderspark.llm import secrets
from tests.llm import brute

TEXTS = [
    None, "", "token=abc", "password=token:abcdefgh", "Secret : 'abc/def=' and API_KEY=\"x.y-z_123\" tail",
    "ééé token=äbcdefgh token = abcdef", "AKIA" + "A" * 15, "AKIA" + "A" * 16 + " AKIAAKIA" + "B7" * 9,
    "f" * 23 + " " + "0a" * 12 + "g", "apikey:" + "deadbeef" * 4, "passwd=abcdefpasswd=ghijkl",
    "mark \u0001 token=abcdef", "x" * 50_000 + " secret=abcdef" * 300,
]


def test_base_spans_match_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in secrets.scan_documents(docs).collect():
        want = brute.base_spans(TEXTS[r.doc_id])
        listed = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (r.doc_id, r.spans, listed)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for _, k, _ in want) for kind in range(3)]
        base = [s for s in r.spans.split(",") if s and not s.startswith("random")]
        assert ",".join(base) == listed


def test_models_tell_random_strings_from_identifiers(spark):
    import random
    import string

    draw = random.Random(1)
    key = lambda n: "".join(draw.choice(string.ascii_letters + string.digits) for _ in range(n))
    words = "customer address delivery statement international configuration parameter repository".split()
    name = lambda: "_".join(draw.choice(words) for _ in range(4))
    known = [(i, f"token={key(40)} {name()} {name()}") for i in range(300)]
    hidden = key(40)
    fresh = [(1000, f"see {hidden} here"), (1001, f"see {name()} here"), (1002, f"password={key(30)}")]
    docs = spark.createDataFrame(known + fresh, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in secrets.scan_documents(docs).filter("doc_id >= 1000").collect()}
    assert spans[1000] == "random:4:44"
    assert spans[1001] == ""
    assert spans[1002] == "assign:0:39"


def test_columns_are_kept_and_plan_has_no_python(spark, capsys):
    docs = spark.createDataFrame([(1, "token=abcdef", "x")], "doc_id long, text string, base_spans string")
    found = secrets.with_spans(docs, [0.0] * len(secrets.ALPHABET) ** 2)
    assert found.columns == ["doc_id", "text", "base_spans", "secrets"]
    found.explain()
    assert "Python" not in capsys.readouterr().out
    empty = secrets.scan_documents(docs.select("doc_id", "text").limit(0))
    assert empty.count() == 0

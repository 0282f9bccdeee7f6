from __future__ import annotations

import hashlib
import random
import re
import string
import subprocess
import sys

import pytest

from lakegate.llm import secret_scan
from tests.llm.helpers import CLASHING, awkward, documents, prose


def base(text):
    """The contract, word for word."""
    text, spans = text or "", []
    key = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "x")  # letters in either case, spelled out
    assert key == "[xX]"
    either = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    words = "|".join([either("password"), either("passwd"), either("secret"), either("token"), either("api") + "_?" + either("key")])
    for m in re.finditer(f"({words})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 12:
            spans.append((m.start(), 0, m.end(), "assign"))
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def test_base_equals_the_contract(spark):
    rng = random.Random(9)
    bits = ["password", "PassWord", "token", "=", ": ", "'", '"', "AKIA", "AKIA" + "Z9" * 8, "0123456789abcdef", "deadbeef",
            "api_key", "apikey=", "secret", "abcdefghijkl", "a.b=c-d/e+f_", " ", "\n", "é", "ſecret", "toKen", "x" * 11]
    rows = awkward([(100 + i, "".join(rng.choices(bits, k=rng.randint(1, 40)))) for i in range(300)])
    rows += [(900, "token=secret: abcdefghijklmnopq"), (901, "AKIAAKIA" + "A" * 14), (902, "😀 token = 'abcdefghijkl'")]
    got = secret_scan.digest(secret_scan.scan(documents(spark, rows))).collect()
    want = []
    for key, text in rows:
        spans = base(text)
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        counts = [sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")]
        want.append((str(key), *counts, hashlib.sha256(joined.encode()).hexdigest()))
        # Base spans are among all spans.
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == sorted(want)
    for r in got:
        listed = [s for s in r.spans.split(",") if s and not s.startswith("random")]
        assert hashlib.sha256(",".join(listed).encode()).hexdigest() == r.base_sha256


def test_random_strings_are_found_and_plain_ones_are_not(spark):
    rng = random.Random(0)
    made = ["".join(rng.choices(string.ascii_letters + string.digits, k=k)) for k in (20, 24, 32, 40, 64) * 20]
    plain = [
        "123e4567-e89b-12d3-a456-426614174000", "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=", "ABCDEF0123456789" * 2,
        "getElementsByClassName2", "internationalization", "src/main/java/org/apache/Main", "2024-01-01-backup-of-server-12",
        "snake_case_name_with_4_parts", "Donaudampfschifffahrtsgesellschaft", "=" * 40, "-" * 30, "12345678901234567890123",
    ]
    rows = [(i, f"see {s} here") for i, s in enumerate(made)] + [(1000 + i, f"see {s} here") for i, s in enumerate(plain)]
    rows.append((2000, prose(1, 3000)))
    got = {r.doc_id: r.spans for r in secret_scan.scan(documents(spark, rows)).collect()}
    hit = [i for i, s in enumerate(made) if any((x["start"], x["end"], x["kind"]) == (4, 4 + len(s), "random") for x in got[i])]
    assert len(hit) >= 99
    assert not [x for i in got for x in got[i] if i >= 1000 and x["kind"] == "random"]


def test_redaction(spark):
    rows = [(1, "a token = 'abcdefabcdefabcd' b"), (2, None), (3, "clean"), (None, "AKIA" + "Q" * 16)]
    df = documents(spark, rows)
    got = secret_scan.redact(df)
    assert got.columns == df.columns and set(CLASHING) < set(got.columns)
    assert {str(r.doc_id): r.text for r in got.collect()} == {"1": "a [SECRET]' b", "2": None, "3": "clean", "None": "[SECRET]"}


@pytest.mark.parametrize("rows", [[]])
def test_empty_table(spark, rows):
    assert secret_scan.scan(documents(spark, rows)).collect() == []
    assert secret_scan.redact(documents(spark, rows)).collect() == []


def test_long_words_with_digits_take_no_time():
    code = "from lakegate.llm.secret_scan import _IDENTIFIER as i; print([bool(i.fullmatch('a' * 60 + d)) for d in ('2024', '20240')])"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=60, check=True)
    assert done.stdout.split("\n")[0] == "[True, False]"


def test_letters_alone_and_short_runs_are_found(spark):
    rng = random.Random(1)
    made = [
        "".join(rng.choices(alphabet, k=k))
        for alphabet, lengths in (
            (string.ascii_letters, (20, 24, 32, 40)),
            (string.ascii_lowercase, (20, 24, 32, 40)),
            (string.ascii_uppercase, (20, 24, 32, 40)),
            (string.ascii_letters + string.digits, (16, 17, 18, 19)),
        )
        for k in lengths * 25
    ]
    plain = [
        "to_be_or_not_to_be", "CONFIGURATION_SETTINGS_MAX", "internationalizations", "unterscheidungsmerkmal", "wissenschaftlichen",
        "misunderstandings", "1234567890123456", "2024-01-01_2024-12-31", "v1/users/v2/items/3", "sha1-utf8-x-int64-get2",
    ]
    rows = [(i, f"see {s} here") for i, s in enumerate(made)] + [(1000 + i, f"see {s} here") for i, s in enumerate(plain)]
    got = {r.doc_id: r.spans for r in secret_scan.scan(documents(spark, rows)).collect()}
    hit = [i for i, s in enumerate(made) if [(x["start"], x["end"], x["kind"]) for x in got[i]] == [(4, 4 + len(s), "random")]]
    assert len(hit) >= 392
    assert not [(rows[i - 1000 + len(made)], x) for i in got for x in got[i] if i >= 1000 and x["kind"] == "random"]
    left = {r.doc_id: r.text for r in secret_scan.redact(documents(spark, rows)).collect()}
    assert all(left[i] == "see [SECRET] here" for i in hit)


def test_random_strings_behind_paths_and_key_names_are_found(spark):
    rng = random.Random(2)
    before = ["src/main/resources/application/production/", "customer-account-verification-link/", "com/services/reset/confirmation/"]
    before += ["CUSTOMER_VERIFICATION_KEY=", "----------------------------------------", "md5_checksums_of_all_customers/", "0123456789abcdef/"]
    after = ["", "/internationalization/configuration/overview", "==", "/ab"]
    alphabet = string.ascii_letters + string.digits
    rows, where = [], {}
    for i in range(280):
        b, value, a = before[i % 7], "".join(rng.choices(alphabet, k=rng.randint(16, 40))), after[i % 4]
        rows.append((i, f"see {b}{value}{a} here"))
        where[i] = 4 + len(b), 4 + len(b) + len(value)
    plain = [
        "src/main/resources/123e4567-e89b-12d3-a456-426614174000/index", "objects/ab/0123456789ABCDEF0123456789ABCDEF01234567/blob",
        "dist/integrity/sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=", "0123456789abcdef0123456789abcdef/internationalization",
        "src/main/v1beta2/us/east-1a/resources/application/configuration", "snake_case_name_with_4_parts/of_a_b_c_to_be_or_not",
    ]
    rows += [(1000 + i, f"see {s} here") for i, s in enumerate(plain)]
    got = {r.doc_id: [s for s in r.spans if s["kind"] == "random"] for r in secret_scan.scan(documents(spark, rows)).collect()}
    assert sum(any(s["start"] <= a and s["end"] >= e for s in got[i]) for i, (a, e) in where.items()) >= 277
    assert not [(i, s) for i in got for s in got[i] if i >= 1000]
    # Where the run is plain as a whole, nothing but the string goes; else all of the run does.
    short = [i for i, (a, e) in where.items() if i % 28 == 0 and e - a < 24]
    assert short and all([(s["start"], s["end"]) for s in got[i]] == [where[i]] for i in short)


def test_long_words_of_the_text_stay_and_random_letters_among_them_are_found(spark):
    rng = random.Random(4)
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if r.text}
    rows, where = [], {}
    for i, text in texts.items():
        alphabet = (string.ascii_lowercase, string.ascii_uppercase, string.ascii_letters)[i % 3]
        value = "".join(rng.choices(alphabet, k=rng.randint(16, 40)))
        at = text.find(" ") + 1
        where[i] = at, at + len(value)
        rows.append((i, f"{text[:at]}{value} {text[at:]}"))
    plain = {r.doc_id: r.spans for r in secret_scan.scan(documents(spark, list(texts.items()))).collect()}
    assert not [s for spans in plain.values() for s in spans if s["kind"] == "random"]
    got = {r.doc_id: [(s["start"], s["end"]) for s in r.spans if s["kind"] == "random"] for r in secret_scan.scan(documents(spark, rows)).collect()}
    assert sum(got[i] == [where[i]] for i in where) >= 0.98 * len(where)
    # Without other words, or among words of another script, there is nothing to compare with.
    alone = [(1, "Schpfgegebeunger"), (2, "слово Schpfgegebeunger слово"), (3, "Schpfgegebeunger " * 3)]
    assert [len(r.spans) for r in secret_scan.scan(documents(spark, alone)).orderBy("doc_id").collect()] == [1, 1, 3]

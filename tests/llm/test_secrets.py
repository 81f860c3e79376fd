"""Secret scans: the six columns against brute force, the base columns against SQL, recall and false positives by alphabet."""

import hashlib
import random
import re
import time

import pytest
from oracle import connect, differences

from tesserae.llm import queries as q
from tesserae.llm import secrets as sc

ALPHABETS = {
    "hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base62": "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base64": "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/", "base64url": "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ-_", "lower and digits": "abcdefghijklmnopqrstuvwxyz0123456789",
}
TEXT = "It was the best of times, it was the worst of times, and {} of wisdom and foolishness; the {} is {} and so it went on, in short, far like the present period."
NAMES = (
    "applicationConfigV2Production01 usrlocalshareapplicationconfig1 getUserAccountBalanceById2 MyCompanyServiceAccountName aws-prod-cluster-us-east-1 2024-01-01T00-00-00 production_database_password1 "
    "/home/user/project/src/main2 com-example-app-v1-2-3-release myAppServiceRefreshToken2 DefaultUserSessionToken1 refreshTokenValiditySeconds30 client_secret_expires_at2 x-amz-security-token-header1 "
    "OAuth2AccessTokenResponse kubernetes_namespace_name1 UserPasswordResetTokenService2 internationalization responsibilities 0000000000000000 deadbeefdeadbeefdeadbeef ABCDEFGHIJKLMNOPQRST ----------------------"
).split()


@pytest.mark.parametrize("name", ALPHABETS)
@pytest.mark.parametrize("length", [16, 20, 24, 31, 40, 64, 128])
def test_recall(name, length):
    rng, n = random.Random(7), sc.Novelty()
    if length == 16 and name not in ("hex", "HEX"):
        pytest.skip("stated from 20 characters on")
    hit = 0
    for _ in range(200):
        key = "".join(rng.choice(ALPHABETS[name]) for _ in range(length))
        t = TEXT.format("age", rng.choice(["access_key", "private key: private_key", "bearer", "client-id"]), key)
        hit += any(t[s:e] == key for s, e, _ in sc.novel_spans(t, [], n)) or any(t[s:e] in key and e - s >= length - 2 for s, e, _ in sc.novel_spans(t, [], n))
    assert hit >= 180, hit


def test_names_are_left_alone():
    """False positives: 1 of these 23 names at most."""
    n = sc.Novelty()
    wrong = [w for w in NAMES if sc.novel_spans(TEXT.format("age", "access_key", w), [], n)]
    assert len(wrong) <= 1, wrong


def slow_columns(text):
    """Base spans by trying every place, one character at a time."""
    spans = []
    for kind, pattern, ok in (
        ("assign", re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[1]) >= 8),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
    ):
        at = 0
        while at < len(text):
            m = pattern.match(text, at)
            if m and ok(m):
                spans.append((m.start(), len(spans), kind, m.end()))
            at = m.end() if m else at + 1
    rank = {"assign": 0, "access": 1, "hex": 2}
    spans = sorted((s, rank[k], k, e) for s, _, k, e in spans)
    return [sum(k == x for _, _, k, _ in spans) for x in ("assign", "access", "hex")], ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)


def texts():
    rng = random.Random(3)
    bits = ['password: "', "PassWD=", "api_key = '", "apikey:", "toKEN", "secret", " = ", ":", "abcdefgh", "short", "AKIA", "ABCDEF123456", "AKIAAKIA0000", "0f" * 16, "0f" * 15, "é", "日本", " ", "\n", "'", "Kſ", "bearer ", "Zx81kQpL0vTn3WbYc7Rd", "_", "="]
    return [None, "", " "] + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(120)]


def test_all_columns_against_brute_force(spark, tmp_path):
    own = texts()
    df = spark.createDataFrame([(i, t, "en", "s", 0, 1, "x") for i, t in enumerate(own)] + [(5, own[5], "en", "s", 0, 1, "x"), (None, "token=abcdefgh1", "en", "s", 0, 1, "x")], "doc_id long, text string, lang string, source string, n_chars long, found int, kind string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = q.op4_secrets(spark, str(tmp_path)).collect()
    assert len(got) == len(own) + 2
    n = sc.Novelty(sc.primer(sc.learned_words(df)))
    for r in got:
        t = "token=abcdefgh1" if r["doc_id"] is None else own[r["doc_id"]] or ""
        counts, base = slow_columns(t)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts and r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest(), t
        rest = [x for x in r["spans"].split(",") if not x.startswith("novel")]
        assert [x for x in rest if x] == [x for x in base.split(",") if x]
        starts = [int(x.split(":")[1]) for x in r["spans"].split(",") if x]
        assert starts == sorted(starts)
        spans = sc.base_spans(t)
        slow = [s for s in sc.novel_spans(t, spans, n) if not any(a < s[1] and s[0] < b for a, b, _ in spans)]
        assert [x for x in r["spans"].split(",") if x.startswith("novel")] == [f"novel:{s}:{e}" for s, e, _ in slow]
    assert sc.secret_spans(df.limit(0), learned=sc.learned_words(df.limit(0))).count() == 0


def test_base_columns_against_sql(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    assert differences(q.secrets_base(spark, sf), connect(sf), q.SECRETS_SQL) == ""
    rows = [(i, t) for i, t in enumerate(texts()) if not t or "ſ" not in t]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert differences(q.secrets_base(spark, str(tmp_path)), connect(str(tmp_path)), q.SECRETS_SQL) == ""


def test_long_texts_of_assignments():
    t = "token = abcdefgh1234 bearer qwertyuiop1234567\n" * 12_000
    at = time.time()
    base = sc.base_spans(t)
    sc.novel_spans(t, base, sc.Novelty())
    assert len(base) == 12_000 and time.time() - at < 20

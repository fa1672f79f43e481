from __future__ import annotations

import random

from pyspark.sql import functions as F

from loadlens.llm import secret_scan as S


def sample(seed=1, n=400):
    """Texts with keys of several makes among long words, numbers and paths."""
    rng = random.Random(seed)
    word = lambda a=2, b=9: "".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]) for _ in range(rng.randint(a, b)))
    pick = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    out = []
    for _ in range(n):
        words = [word(1, 3) for _ in range(30)]
        secret = None
        kind = rng.randrange(6)
        if kind == 0:
            secret = "AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16)
            words.insert(rng.randrange(30), secret)
        elif kind == 1:
            secret = pick("0123456789abcdef", 40)
            words.insert(rng.randrange(30), f'token = "{secret}"')
        elif kind == 2:
            words.insert(rng.randrange(30), word(8, 12))
        elif kind == 3:
            words.insert(rng.randrange(30), pick("0123456789", 16))
        elif kind == 4:
            words.insert(rng.randrange(30), "/".join(word(2, 3) for _ in range(4)))
        out.append((" ".join(words), secret))
    return out


def test_held_out_accuracy(make):
    """Trained on some texts, judged on others, whose labels are known from how they were made."""
    old, new = sample(1), sample(2)
    docs, later = make([t for t, _ in old]), make([t for t, _ in new])
    words = S.dictionary(docs)
    found = S.candidates(docs, words)
    model = S.train(found, S.rule_labels(found))
    assert model is not None
    judged = S.judge(S.candidates(later, words), model).collect()
    truth = {s for _, s in new if s}
    flagged = {r["value"] for r in judged if r["secret"]}
    assert truth <= {r["value"] for r in judged}
    assert len(truth & flagged) >= 0.97 * len(truth) and len(flagged - truth) <= 0.02 * len(judged)
    texts = [t for t, _ in new]
    assert all(texts[r["doc_id"]][r["start"] : r["stop"]] == r["value"] for r in judged)


def test_given_labels_overrule_the_rules(spark, make):
    rng = random.Random(3)
    keys = ["".join(rng.choice("abcdef0123456789") for _ in range(32)) for _ in range(60)]
    docs = make([f"sum {k} of the file" for k in keys])
    labels = spark.createDataFrame([(k, 0) for k in keys[:40]] + [("AKIA" + "A" * 16, 1)], "value string, secret int")
    assert S.scan(docs, labels).where("secret").count() == 0  # too few of one label: the rules, which flag none


def test_table_findings_and_redaction(documents):
    found = S.scan(documents).cache()
    secrets = {r["value"] for r in found.where("secret").collect()}
    for r in documents.where("text LIKE '%AKIA%'").collect():
        key = r["text"][r["text"].index("AKIA") :][:20]
        assert key in secrets
    out = S.redact(documents, found)
    assert out.count() == documents.count()
    assert not any(s in r["text"] for r in out.where("text IS NOT NULL").collect() for s in secrets)
    same = documents.join(found.where("secret").select("doc_id").distinct(), "doc_id", "left_anti")
    assert same.select("doc_id", "text").exceptAll(out.select("doc_id", "text")).isEmpty()
    found.unpersist()


def test_odd_rows_and_none(odd, nothing):
    found = S.scan(odd)
    assert found.where("secret").isEmpty()
    assert S.scan(nothing).count() == 0
    assert S.redact(odd, found.withColumn("secret", F.lit(False))).columns[:5] == odd.columns[:5]


def test_key_blocks_and_short_values(make):
    block = "-----BEGIN RSA PRIVATE KEY-----\nabc\ndef\n-----END RSA PRIVATE KEY-----"
    docs = make([f"x {block} y", "password: hunter2hunter2, next", "the password is kept"])
    got = {(r["doc_id"], r["value"]) for r in S.scan(docs).where("secret").collect()}
    assert got == {(0, block), (1, "hunter2hunter2")}


def test_long_names_keys_and_encrypted_blocks(make):
    """A name of many key characters does not swallow the value that it tells of."""
    block = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\nabc\n-----END RSA PRIVATE KEY-----"
    texts = [
        "DB_ADMIN_PASSWORD=Tr0ub4dor", "DB_ADMIN_PASSWORD = Tr0ub4dor", '"service_account_password": "Tr0ub4dor"',
        "config/prod/db_password=Tr0ub4dor", f"private_key = {block}", f"-----BEGIN RSA PRIVATE KEY-----\ncut off\n{block}",
    ]
    found = S.candidates(make(texts), frozenset()).collect()
    values = [{r["value"] for r in found if r["doc_id"] == k} for k in range(len(texts))]
    assert all("Tr0ub4dor" in x for x in values[:4])
    assert block in values[4] and block in values[5]
    for k, text in enumerate(texts):
        own = sorted((r["start"], r["stop"], r["value"]) for r in found if r["doc_id"] == k)
        assert all(text[a:b] == v for a, b, v in own)
        assert all(x[1] <= y[0] for x, y in zip(own, own[1:]))


def test_named_words_and_numbers_are_no_sure_negatives(make):
    texts = ["password=correcthorsebattery", "token: 8274619302", "the correcthorsebattery runs", "a plain correcthorsestapler"]
    found = S.candidates(make(texts), frozenset())
    assert {r["value"]: r["secret"] for r in S.rule_labels(found).collect()} == {"correcthorsestapler": 0}
    secret = {(r["doc_id"], r["value"]) for r in S.scan(make(texts)).where("secret").collect()}
    assert secret == {(0, "correcthorsebattery"), (1, "8274619302")}


def test_masks_are_judged_as_findings_are(spark, make):
    """The forest inside the tasks has the chances of the one in Spark, and masks the same spans."""
    docs = make([t for t, _ in sample(4, 150)])
    words = S.dictionary(docs)
    found = S.candidates(docs, words)
    model = S.train(found, S.rule_labels(found))
    rows = S.judge(found, model).collect()
    got = S.chances(S.forest(model), S.np.array([r["features"] for r in rows]), [r["rule"] for r in rows])
    assert len(rows) > 100 and abs(got - [r["probability"] for r in rows]).max() < 2e-6
    one, two = S.mask(docs, words, model), S.redact(docs, S.judge(found, model))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def plain_spans(text):
    """The rule of ``_spans`` letter by letter: each kind takes what the kinds before have left."""
    owner = [None] * len(text)
    out = []
    for kind, (pattern, least) in S._KINDS.items():
        taken = owner[:]
        for found in pattern.finditer(text):
            a, b = found.span("value")
            parts, at = [], a
            for k in range(a, b + 1):
                if k == b or taken[k] is not None:
                    if k - at >= least:
                        parts.append((at, k))
                    at = k + 1
            for x, y in parts:
                out.append((x, y, kind))
                owner[x:y] = [kind] * (y - x)
    return sorted(out)


def test_spans_against_a_plain_version():
    rng = random.Random(11)
    parts = ["password=", "token: ", "AKIA" + "B" * 16, "abc123" * 4, "x", " ", "-----BEGIN PRIVATE KEY-----", "-----END PRIVATE KEY-----", "/", "==", "\"", "secret", "=", "0aZ_" * 5]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 9)))
        assert S._spans(text) == plain_spans(text), text

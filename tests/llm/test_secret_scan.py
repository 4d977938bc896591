import collections
import hashlib
import itertools
import math
import random
import re
import string

from millrace.llm import secret_scan

ASSIGN = re.compile(r"(?a)((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ORDER = ["assign", "access", "hex", "random"]
CLASS = lambda c: "d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "s"
D, L, U = string.digits, string.ascii_lowercase, string.ascii_uppercase
ALPHABETS = [D, L, U, D + "abcdef", D + "ABCDEF", U + "234567", D + L, D + U, U + L, D + U + L, U + L + D + "+/", U + L + D + "-_", U + L + D + "+/-_="]


def base(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24])


def ln_tail(z):
    return math.log(0.5 * math.erfc(z / math.sqrt(2))) if z < 30 else -z * z / 2 - math.log(z * math.sqrt(2 * math.pi))


def battery(value):
    s = value.rstrip("=") or value
    a = next(a for a in ALPHABETS if set(s) <= set(a))
    k, n, at = len(a), len(s), [a.index(c) for c in s]
    chi = (k / n * sum(v * v for v in collections.Counter(s).values()) - n - (k - 1)) / math.sqrt(2 * (k - 1) * (1 - 1 / n))
    kind = {c: CLASS(c) for c in a}
    if len(set(kind.values())) == 1:
        kind = {c: "ab"[i >= k // 2] for i, c in enumerate(a)}
    share = collections.Counter(kind.values())
    q = 1 - sum((x / k) ** 2 for x in share.values())
    q2 = sum(x / k * (1 - x / k) ** 2 for x in share.values())
    changes = sum(kind[x] != kind[y] for x, y in itertools.pairwise(s))
    run = (changes - (n - 1) * q) / math.sqrt((n - 1) * q * (1 - q) + 2 * (n - 2) * (q2 - q * q))
    mid = (k - 1) / 2
    serial = sum((x - mid) * (y - mid) for x, y in itertools.pairwise(at)) / ((k * k - 1) / 12) / math.sqrt(n - 1)
    good = min(ln_tail(chi), *(min(0, math.log(2) + ln_tail(abs(z))) for z in (run, serial))) >= math.log(1e-3)
    pairs, every, triples = sum(v * (v - 1) / 2 for v in collections.Counter(s.lower()).values()), n * (n - 1) / 2, n * (n - 1) * (n - 2) / 6
    few = (pairs - every * 0.065) / math.sqrt(every * 0.065 * 0.935 + 6 * triples * (0.0054 - 0.065**2))
    x = sum(CLASS(x) != CLASS(y) for x, y in itertools.pairwise(s)) / (n - 1)
    far = 0 if x <= 0.12 else x * math.log(x / 0.12) + ((1 - x) * math.log((1 - x) / 0.88) if x < 1 else 0)
    strange = (n - 1) * far - ln_tail(-few)
    return good, n, math.log(1 + strange) - strange


def brute(docs):
    found, candidates = [base(t or "") for _, t in docs], []
    for d, (_, t) in enumerate(docs):
        for m in re.finditer("[A-Za-z0-9+/_=-]{16,}", t or ""):
            if not any(a <= m.start() and m.end() <= b for a, _, b in found[d]):
                good, n, ln = battery(m.group())
                candidates.append((d, m.start(), m.end(), good, int(math.log2(n)), math.floor(-ln / math.log(10) * 100)))
    by = collections.defaultdict(list)
    for c in candidates:
        by[c[4]].append(c[5])
    bar = {}
    for o, steps in by.items():
        ok = [s for s in set(steps) if 10 ** (-s / 100) * len(steps) <= 0.01 * sum(x >= s for x in steps)]
        bar[o] = min(ok, default=math.inf)
    whole = [list(f) for f in found]
    for d, a, b, good, o, step in candidates:
        if good and step >= bar[o]:
            whole[d].append((a, 3, b))
    out = []
    for (i, _), own, every in zip(docs, found, whole):
        said = lambda f: ",".join(f"{ORDER[k]}:{a}:{b}" for a, k, b in sorted(f))
        out.append((i, *(sum(k == x for _, k, _ in own) for x in range(3)), hashlib.sha256(said(own).encode()).hexdigest(), said(every)))
    return sorted(out, key=repr)


def got(spark, docs):
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in docs], "doc_id long, text string, row int, kind string, value string").repartition(3)
    return sorted((tuple(r) for r in secret_scan.summary(secret_scan.scan(df)).collect()), key=repr)


def key(r, alphabet, n):
    return "".join(r.choice(alphabet) for _ in range(n))


def planted(prose):
    r = random.Random(7)
    docs, keys = [], {}
    for i in range(120):
        t = prose(i, 60) + f" https://host/path/to/some/long/place{i}/ {key(r, D, 16)} supercalifragilisticword someCamelCaseIdentifier{i} 2024-01-{i % 28 + 1:02d}-run-{i}-of-the-day"
        if i % 4 == 0:
            k = key(r, r.choice([D + U + L, U + L + D + "+/", "0123456789ABCDEF"]), r.randint(28, 70))
            keys[i] = k
            t = t.replace(" ", f" é {k} ", 1)
        docs.append((i, t))
    return docs, keys


def test_equals_brute_force_and_finds_planted_secrets(spark, prose):
    docs, keys = planted(prose)
    made = got(spark, docs)
    assert made == brute(docs)
    told = {r[0]: r[5] for r in made}
    texts = dict(docs)
    hit = sum(f"random:{texts[i].index(k)}:{texts[i].index(k) + len(k)}" in told[i] for i, k in keys.items())
    assert hit >= 0.9 * len(keys)
    assert sum("random" in s for i, s in told.items() if i not in keys) == 0


def test_base_spans(spark):
    hexa = "0123456789abcdef" * 2
    docs = [
        (1, 'password = "hunter22" passwd:\'short\' API_KEY:  abcdef, apikey="a.b-c_d/e=f" SeCrEt=token: abcdefgh'), (2, "token=token=abcdefgh tokentoken:abcdef token==abcde"),
        (3, "AKIA" + "A1" * 8 + " AKIA123 xAKIAAKIA" + "Z" * 12 + " AKIA" + "B" * 15), (4, f"{hexa[:24]} {hexa[:23]} x{hexa}y {hexa.upper()}"), (5, None), (6, ""), (None, f"日本é token={hexa}"),
        (2**60 + 1, "ſecret=abcdefgh toKen=abcdefgh"), (7, "secret=abcde"), (7, "secret=abcdef"), (7, "secret=abcdef"), (8, ("token=abcdefg " * 3000) + "end"), (9, "x" * 70_000 + " " + "ab1" * 9),
    ]
    assert got(spark, docs) == brute(docs)


def test_lengths_count(spark, prose):
    """Among many ordinary strings, a string that is a discovery at one length is none when it is cut short."""
    r = random.Random(3)
    whole = [key(r, "0123456789ABCDEF", 60) for _ in range(5)]
    ordinary = [(100 + i, "".join(w.lower() for w in re.findall("[a-zA-Z]+", prose(i, 12)))[: 17 + i % 40]) for i in range(400)]
    found = lambda n: {x[0] for x in got(spark, [(i, f"a {k[:n]} b") for i, k in enumerate(whole)] + ordinary) if "random" in x[5]}
    assert found(60) == set(range(5)) and found(16) == set()


def test_no_python_on_the_path(spark, no_docs, odd_docs):
    df = secret_scan.matches(odd_docs)
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
    assert secret_scan.summary(secret_scan.scan(no_docs)).count() == 0
    assert secret_scan.summary(secret_scan.scan(odd_docs)).count() == odd_docs.count()

"""The training-data operators against brute force, and on their edge cases."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corvane.llm import common, decontaminate, html_extract, langid, line_dedup, packing, quality, secrets, simhash, token_count, toxicity

SCHEMA = "doc_id long, text string"
#: Nulls, empty and blank texts, ties, repeated rows, a long text.
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "same words here twice"), (4, "same words here twice"), (None, "no id"), (None, None), (7, "x " * 20000), (8, "Ünï 中文 😀")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def words():
    rng = random.Random(5)
    return ["".join(rng.choices("abcdefgh", k=3)) for _ in range(40)]


def test_decontaminate_brute_force(spark, words):
    rng = random.Random(1)
    items = [(i, " ".join(rng.choices(words, k=rng.choice([0, 3, 9, 10, 30])))) for i in range(30)] + [(99, None)]
    docs = [(i, " ".join(rng.choices(words, k=40)) + " " + (rng.choice(items)[1] or "").upper() + ". " + " ".join(rng.choices(words, k=5))) for i in range(80)]
    found, (_, spans, who) = decontaminate.match(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), block_words=120)
    got = {r["doc_id"]: (r[spans], r[who]) for r in found.collect()}
    for doc, text in docs:
        ws, hit, ids = re.findall("[a-z0-9]+", text.lower()), set(), set()
        for item, t in items:
            own = (t or "").split()
            n = min(len(own), 10)
            windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()
            for k in range(len(ws)):
                if n and tuple(ws[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    ids.add(str(item))
        at = got[doc][0]
        assert {x for s, e in zip(at[::2], at[1::2]) for x in range(s, e)} == hit
        assert got[doc][1] == sorted(ids)


def test_decontaminate_edges(spark, odd, empty):
    items = spark.createDataFrame([(1, "same words here"), (1, "same words here"), (None, None)], "item_id long, text string")
    got = decontaminate.report(odd, items).collect()
    assert len(got) == len(ODD) and sum(r["contaminated"] for r in got) == 2
    assert decontaminate.report(odd, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.report(empty, items).count() == 0
    clash = odd.withColumn("n_words", F.lit(1)).withColumn("hit_spans", F.lit("x"))
    clean = decontaminate.decontaminate(clash, items, max_coverage=1.0)
    assert clean.columns == clash.columns and clean.where("doc_id = 4").first()["text"].strip() == "twice"


def brute_lines(rows, least):
    key = lambda x: "".join(c.lower() if c < "\x80" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    held: dict = {}
    for doc, text in rows:
        for x in (text or "").split("\n"):
            if key(x):
                held.setdefault(key(x), set()).add(doc)
    many = {k for k, v in held.items() if len(v) >= least}
    return [(doc, "\n".join(x for x in (text or "").split("\n") if key(x) not in many)) for doc, text in rows]


def test_line_dedup(spark, odd, empty):
    rng = random.Random(2)
    rows = [(i, "\n".join([" Common "] * (i % 3 > 0) + [f"line {rng.randrange(30)}" for _ in range(rng.randrange(8))] + [""])) for i in range(200)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA), min_docs=10, keep="none")
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == sorted(brute_lines(rows, 10))
    first = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA), min_docs=10, keep="first").collect()
    text = "\n".join(r["text"] for r in first)
    assert text.count(" Common ") == 1 and all(len(re.findall(rf"^line {k}$", text, re.M)) == 1 for k in range(30))
    assert line_dedup.report(odd).count() == len(ODD)
    assert {r["kept_sha256"] for r in line_dedup.report(odd).where("doc_id <= 2").collect()} == {hashlib.sha256(b"").hexdigest()}
    assert line_dedup.report(empty).count() == 0
    clash = odd.withColumn("keep_bits", F.lit(1)).withColumn("doc", F.lit(2))
    assert line_dedup.dedup_lines(clash).columns == clash.columns


@pytest.mark.parametrize("batch", [3, 10000])
def test_line_dedup_repeated_rows(spark, batch):
    """The first holder of a frequent line may be a repeated row, with or without an id; also where a batch or a partition ends between the copies."""
    held = [(None, "Nowhere\nx\nNowhere")] * 3 + [(0, "Common\na\nCommon")] * 2 + [(i, f"Common\nown {i}\n") for i in range(1, 30)]
    rows = held + [(None, f"Nowhere\n{i}") for i in range(3)] + [(i, f"b{i}\nNowhere else\nCommon") for i in range(30, 60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = [(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs, min_docs=10, keep="first").collect()]
        lone = line_dedup.dedup_lines(spark.createDataFrame(held[:3], SCHEMA), min_docs=1, keep="first").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [t for i, t in got if i == 0] == ["Common\na"] * 2
    assert sum("Common" in t for i, t in got if i != 0) == 0
    assert sum("Nowhere else" in t for _, t in got) == 1 and sum(t == "Nowhere\nx\nNowhere" for _, t in got) == 3
    assert [r["text"] for r in lone] == ["Nowhere\nx"] * 3


def test_line_bitmap():
    packed = line_dedup.bitmap([1, 9])
    assert line_dedup.apply_bitmap(b"\n".join(b"%d" % i for i in range(20)), packed)[:2] == (20, 2)


def test_quality_counts():
    text = "a b c x a b c\n\n#one\n#one\n é\n"
    assert quality.base_counts(text.encode()) == (10, 16, 2, 1, 6)
    assert quality.base_counts(None) == quality.base_counts(b"") == (0, 0, 0, 0, 0)


def test_quality_learns(spark, odd, labels, sf_dir):
    docs, marks = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out, names = quality.judge(docs.select("doc_id", "text"), quality.train(docs, marks))
    rows = out.join(marks, "doc_id").collect()
    assert np.mean([r[names[-1]] for r in rows if r["quality"] == 1 and not r[names[5]]]) > 0.9
    assert np.mean([r[names[-1]] for r in rows if r["quality"] == 0]) < 0.2
    assert quality.report(odd, labels).count() == len(ODD)


def test_encoder():
    own = packing.Encoder(packing.vocabulary_path())
    rng = random.Random(3)
    parts = list("abXYé中σΣ.,!'-#9 \n\t\x1c\x85\xa0") + ["<|endoftext|>", "<|ENDOFTEXT|>", "don't "]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))).encode() for _ in range(2000)]
    assert own.encode([*texts, None]) == [*(own.whole(x) for x in texts), b""]


def test_encoder_words():
    """Words of plain letters don't pass the tokenizer's normalizer and pattern, and have the ids that it gives."""
    own, rng, asked = packing.Encoder(packing.vocabulary_path()), random.Random(5), []
    letters = [chr(x) for x in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)) if chr(x).isalpha()]
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 12))) for _ in range(4000)]
    text = "".join(w + rng.choice([" ", "\n", "\t ", "  "]) for w in words).encode()
    tokenizer = own.tokenizer

    class Counted:
        def encode(self, text, **options):
            asked.append(text)
            return tokenizer.encode(text, **options)

    own.tokenizer = Counted()
    got = own.encode([text, None, text[:60].decode(errors="ignore").encode() + b"-- end.", b" \n"])
    assert len(asked) == 1 and set(asked[0].split()) == {"--", "."}
    own.tokenizer = tokenizer
    assert got == [own.whole(text), b"", own.whole(text[:60].decode(errors="ignore").encode() + b"-- end."), b""]


def test_encoder_long(monkeypatch):
    """A long text goes in parts, and little memory of chunks changes no ids."""
    monkeypatch.setattr(packing, "SLICE_BYTES", 50)
    own, rng = packing.Encoder(packing.vocabulary_path(), size=20), random.Random(6)
    for gaps in (" \n\t\r\x0b\x0c", "\u3000\x1c", "."):
        parts = list("abÉ中σ.,'-#9") + list(gaps)
        for _ in range(20):
            text = "".join(rng.choices(parts, k=700)).encode()
            assert own.encode([text]) == [own.whole(text)]


def test_packing(spark, odd, empty):
    rows = packing.pack(odd, with_ids=True).collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == by.get(r["sequence_id"], 0)
        by[r["sequence_id"]] = r["offset"] + r["length"]
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    total = sum(r["length"] for r in rows)
    assert max(by.values()) <= 2048 and len(by) == -(-total // 2048)
    assert sum(r["piece"] == 0 for r in rows) == len(ODD)
    assert packing.pack(empty).count() == 0


def test_packing_plan():
    rng = random.Random(4)
    for _ in range(20):
        counts = {rng.randrange(1, 65): rng.randrange(1, 50) for _ in range(20)}
        steps, used = packing.plan(counts, 64), {}
        for times, kinds in steps:
            assert times > 0 and sum(n * k for n, k in kinds) <= 64
            for n, k in kinds:
                used[n] = used.get(n, 0) + times * k
        assert used == counts


def test_language(spark, odd, empty, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = langid.report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert {r["lang_pred"] for r in langid.report(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.report(empty.withColumn("lang", F.lit("en"))).count() == 0


def test_language_bundle():
    """A text's vector is the sum of its trigrams' bound vectors."""
    letters = langid.letter_vectors()
    codes = langid.trigrams("Banana ñu")
    brute = sum(np.roll(letters[c >> 18], 2).astype(int) * np.roll(letters[c >> 9 & 511], 1) * letters[c & 511] for c in codes.tolist())
    assert (langid.bundled([langid.counted("Banana ñu")], letters)[0] == brute).all()


def test_simhash_fingerprint():
    text = "The  quick brown fox\njumps OVER the lazy dog É"
    ws = [x.lower() for x in text.split()]
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i : i + 4]), seed=42) for i in range(len(ws) - 3)]
    ws[-1] = "É"  # letters beyond ASCII keep their case
    hashes[-1] = xxhash.xxh64_intdigest(" ".join(ws[-4:]), seed=42)
    wanted = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text.encode()) == wanted
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \n") == 0


def test_simhash_planes():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    values = np.unique(np.r_[base, base ^ np.uint64(0b1011), base ^ np.uint64(1 << 60)])
    planes = simhash.Planes(values)
    for v in values[:50].tolist():
        for radius in (0, 3, 4, 14):
            assert planes.near(v, radius).tolist() == np.flatnonzero(np.bitwise_count(values ^ np.uint64(v)) <= radius).tolist()


def test_simhash_components(spark):
    rng = np.random.default_rng(7)
    centre = rng.integers(0, 2**63, 40, dtype=np.uint64)
    chain = [centre[0]]
    for i in range(12):
        chain.append(chain[-1] ^ np.uint64(0b1111 << (4 * i)))  # a path whose ends are far apart
    values = np.unique(np.r_[centre, centre[5:20] ^ np.uint64(0b10001), np.array(chain, dtype=np.uint64)])
    rows = spark.createDataFrame([(i, v, i) for i, v in enumerate(values.view(np.int64).tolist())], "id long, f long, tag long")
    got = {r["f"]: r["component"] for r in simhash.group(rows, "id", "f", "tag").collect()}
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4).tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    assert [got[v] for v in values.view(np.int64).tolist()] == [find(i) for i in range(len(values))]


def test_simhash_dedup(spark, odd, empty):
    text = " ".join(f"word{i}" for i in range(200))
    rows = [(1, text), (2, text), (3, text.replace("word50 ", "other ")), (4, " ".join(f"else{i}" for i in range(200)))]
    assert sorted(r["doc_id"] for r in simhash.dedup(spark.createDataFrame(rows, SCHEMA)).collect()) == [1, 4]
    assert simhash.report(odd).count() == len(ODD)
    zero = simhash.report(odd).where("fingerprint = '0000000000000000'").collect()
    assert {r["component_id"] for r in zero} == {1}
    assert simhash.report(empty).count() == 0
    clash = odd.withColumn("row_tag", F.lit(1)).withColumn("fingerprint", F.lit(2))
    assert simhash.dedup(clash).columns == clash.columns


def copies(rng, n, low, high):
    """Pairs of texts, (2i, text) and (2i + 1, its tail changed), with a Jaccard similarity of their five-word shingles between low and high."""
    rows = []
    while len(rows) < 2 * n:
        ws = [f"w{rng.randrange(10**9)}" for _ in range(rng.randrange(30, 300))]
        m, k = len(ws) - 4, rng.randrange(1, len(ws) // 2)
        if low <= (m - k) / (m + k) < high:
            rows += [(len(rows), " ".join(ws)), (len(rows) + 1, " ".join(ws[:-k] + [f"v{rng.randrange(10**9)}" for _ in range(k)]))]
    return rows


def test_simhash_similarity(spark):
    """Near copies have an exact similarity of 0.8; texts that are less alike stay, also where they are linked by others."""
    rng = random.Random(10)
    less = copies(rng, 60, 0.6, 0.79)
    more = [(i + 1000, t) for i, t in copies(rng, 20, 0.95, 1)]
    again = [(5000, less[0][1]), (None, less[1][1])]
    got = simhash.dedup(spark.createDataFrame(less + more + again, SCHEMA)).collect()
    assert sorted(r["doc_id"] for r in got) == [i for i, _ in less] + [i for i, _ in more if i % 2 == 0]


def test_simhash_recall(spark):
    """Pairs at 0.8 to 0.85 are found as by brute force, also where a text repeats itself."""
    rng = random.Random(12)
    rows = copies(rng, 600, 0.8, 0.85)
    loop = " ".join(f"r{i}" for i in range(40))
    rows += [(2000, loop + " x y z " + loop), (2001, " ".join([loop] * 30) + " x y z " + loop)]
    got = sorted(r["doc_id"] for r in simhash.dedup(spark.createDataFrame(rows, SCHEMA)).collect())
    wanted = []
    for (i, a), (j, b) in zip(rows[::2], rows[1::2]):
        a, b = ({tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in (a.split(), b.split()))
        wanted += [i] if 5 * len(a & b) >= 4 * len(a | b) else [i, j]
    assert got == wanted


def test_simhash_alike():
    rng = random.Random(11)
    for _ in range(50):
        sets = [np.array(sorted(rng.sample(range(14), rng.randrange(0, 13))), dtype=np.uint64) for _ in range(25)]
        group = list(range(25))
        for i in range(25):
            for j in range(i):
                a, b = set(sets[i].tolist()), set(sets[j].tolist())
                if a and 5 * len(a & b) >= 4 * len(a | b):
                    group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
        assert simhash.alike(sets) == group


def brute_secrets(text: str) -> list[tuple[str, int, int]]:
    """Base spans, character by character from the left."""
    out = []
    for kind, pattern, group, least in (
        ("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
        ("access", r"(AKIA[A-Z0-9]+)", 1, 18),
        ("hex", r"([0-9a-f]+)", 1, 16),
    ):
        at = 0
        while at < len(text):
            m = re.compile(pattern).match(text, at)
            if m and m.end() > at:
                if len(m[group]) >= least:
                    out.append((kind, m.start(), m.end()))
                at = m.end()
            else:
                at += 1
    return sorted(out, key=lambda x: (x[1], ["assign", "access", "hex"].index(x[0])))


def test_secret_base_spans():
    rng = random.Random(3)
    parts = ["password", "Secret", "api_key", "APIKEY", "token", '"', "'", " ", "  ", ":", "=", "\n", "AKIA", "ABCDEFGH12", "deadbeef", "0123456789", "é", "x.y-z", "qwertyuiop"]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=rng.randrange(25)))
        raw = text.encode()
        got = [(k, s, e) for s, e, k in sorted(secrets.base_spans(text, raw), key=lambda x: (x[0], secrets.KINDS.index(x[2])))]
        assert got == brute_secrets(text), text


def test_secrets(spark, odd, empty):
    text = 'é password = "abcdefGHIJ12" x AKIAABCDEFGHIJ1234 and deadbeefdeadbeef99, bearer: q7Zk3vXw9LmPt2RbYh5sD8kQ api_key=user_name_token'
    spans = secrets.scan(text.encode())
    assert [(k, text[s:e][:6]) for s, e, k in spans] == [("assign", "passwo"), ("access", "AKIAAB"), ("hex", "deadbe"), ("novel", "q7Zk3v"), ("assign", "api_ke")]
    assert secrets.scan(b"the bearer walked along internationalisation") == [] == secrets.scan(None)
    assert secrets.report(odd).where("spans = ''").count() == len(ODD)
    assert secrets.report(empty).count() == 0
    clash = odd.withColumn("secrets", F.lit(1)).withColumn("spans", F.lit("x"))
    assert secrets.find_secrets(clash)[0].columns[:4] == clash.columns


def test_secrets_told_apart():
    """Random tokens of any alphabet and length against identifiers made of words that the dictionary wasn't built from."""
    import json
    import string

    import public_tokenizers

    rng = random.Random(13)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        words = sorted({w[1:].lower() for w in json.load(file)["model"]["vocab"] if re.fullmatch("\u0120[A-Za-z][a-z]{2,12}", w)})
    alphabets = (string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits, "0123456789ABCDEF", string.ascii_lowercase + string.digits, string.ascii_lowercase)
    found = total = 0
    for alphabet in alphabets:
        for n in (16, 24, 40, 64, 128, 256):
            for _ in range(6):
                token = "".join(rng.choices(alphabet, k=n))
                text = f"the bearer is {token} here, and the key is {token}, again" if rng.random() < 0.3 else f"session key {token} and so on"
                found += all(text[s:e] == token for s, e, _ in secrets.scan(text.encode())) and bool(secrets.scan(text.encode()))
                total += 1
    assert found >= 0.9 * total
    wrong = tried = 0
    for _ in range(300):
        ws = rng.sample(words, rng.randrange(3, 6))
        name = rng.choice([ws[0] + "".join(map(str.capitalize, ws[1:])), "_".join(ws), "-".join(ws).upper(), "/" + "/".join(ws), "".join(map(str.capitalize, ws)) + "V2"])
        if len(name) >= secrets.MIN_NOVEL:
            wrong += bool(secrets.scan(f"the key is {name} here".encode()))
            tried += 1
    assert wrong <= 0.08 * tried
    for name in ("getUserSessionTokenFromCache", "user_session_key_name_V2", "src/main/java/com/example/auth/TokenProvider", "Internationalization-2-Handbook", "Z" * 24, "-" * 24):
        assert secrets.scan(f"the key is {name} here, the key is {name}".encode()) == []


def test_html():
    page = """<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href=x>Menu</a></li></ul></nav>
    <div class="cookie-notice">We use cookies</div><header>Site</header><article><h1>Head &amp; more</h1><p><b>One<br>two <i>in</i>line<p>Three</p>
    <div class="ad">Buy</div><aside>Side</aside><form>Name</form><p>Four &#233;</p><section class="comments"><p>Reader says</p></section></article>
    <footer>&copy; us</footer></body></html>"""
    assert html_extract.extract(page) == "Head & more\n\nOne two inline\n\nThree\n\nFour é"
    body = "A long paragraph of running text that goes on for quite a while and says something."
    plain = f"<body><div><a href=1>Home</a> <a href=2>News</a></div><div><p>{body}</p><p>Short.</p><p>{body}</p></div><div><a href=3>More links here</a></div></body>"
    assert html_extract.extract(plain) == f"{body}\n\nShort.\n\n{body}"
    assert html_extract.extract(None) == html_extract.extract("") == html_extract.extract("<nav>x</nav>") == ""


def test_html_unnamed():
    """On a page without article or main, boilerplate inside the text splits nothing off."""
    ad = "<div class=ad><p>Buy</p><p>this</p><p>now</p><p>please</p></div>"
    text = [f"Paragraph {i} of the running text, which goes on for a while and says something of its own." for i in range(10)]
    body = "".join(f"<p>{x}</p>" for x in text[:8]) + ad + "".join(f"<p>{x}</p>" for x in text[8:])
    menu = "<div><a href=1>Home</a><br><a href=2>News</a></div>"
    page = f"<body>{menu}<p>Site</p><div class=post><p>By me.</p>{ad}{body}{ad}<ul><li>The end.</li></ul></div>{menu}{menu}{menu}<div><p>Imprint</p></div></body>"
    assert html_extract.extract(page) == "\n\n".join(["By me.", *text, "The end."])


def test_html_wrappers():
    """A wrapper's name, or a head that is never closed, hides no article; boilerplate inside it stays out."""
    article = "<article><p>The text.</p><div class='ad-slot'>Buy</div><p>The end.</p></article>"
    for start in (
        "<div class='layout has-sidebar'>", "<div id='page-with-comments'>", "<div class='no-sidebar'>", "<div class=comments-open>", "<div class=popup>", "<form>",
        "<head><title>T</title><meta charset=utf-8>", "<head><title>T</title><body class=has-nav>", "<head><link href=x><div>",
    ):
        assert html_extract.extract(start + article) == "The text.\n\nThe end.", start
    assert html_extract.extract(f"<div class=related><article>Else</article></div>{article}<aside><article>More</article></aside>") == "The text.\n\nThe end."
    for name in ("comments", "comment-list", "site-footer", "mainNav", "wide sidebar", "cookie_notice"):
        assert html_extract.extract(f"<article><p>Yes</p><div class='{name}'><p>No</p></div></article>") == "Yes"
    assert html_extract.extract("<aside><article>More</article></aside>") == ""


def test_html_window():
    """The distribution decides: a run of links is a dive, and text after it stays only where it surges or shares a container with what does."""
    body = "A long paragraph of running text that goes on for quite a while and says something."
    links = "".join(f"<li><a href={i}>Link number {i}</a></li>" for i in range(6))
    page = f"<article><div><p>{body}</p><p>{body}</p></div><ul>{links}</ul><div><p>Short end.</p></div></article>"
    assert html_extract.extract(page) == f"{body}\n\n{body}"
    again = page.replace("Short end.", body + " More.")
    assert html_extract.extract(again).endswith("Link number 5\n\n" + body + " More.")
    beside = f"<article><p>{body}</p><ul>{links}</ul><p>Short end.</p></article>"
    assert html_extract.extract(beside) == f"{body}\n\nShort end."
    found = html_extract.Page(page)
    weights = np.array([len(x.text) if 2 * x.linked < len(x.text) else 0 for x in found.lines], dtype=float)
    total = [weights[max(0, i - 1) : i + 2].sum() for i in range(len(weights))]
    assert html_extract.stretches(weights, 3, 80) == [(0, 2, 2.0 * len(body))] and total[4] == 0


def test_html_keeps():
    """Nothing inside an article goes for a word in its name; what goes are containers that are called boilerplate and nothing else."""
    inside = (
        "<p>One.</p><p class=share>A share of the market grew.</p><section id=related-work><p>Related</p></section><div class='notice-of-intent'>N</div>"
        "<dialog>D</dialog><p>x <math><mi>y</mi></math></p>"
    )
    gone = "<ul class=thread><li>Reader</ul><div class='comment-list'>C</div><div id=newsletter>L</div><aside>S</aside><form>Name</form>"
    assert html_extract.extract(f"<article>{inside}{gone}</article>") == "One.\n\nA share of the market grew.\n\nRelated\n\nN\n\nD\n\nx y"
    cards = "<article><a href=x>Teaser</a><p>Short.</p></article>" * 3
    assert html_extract.extract(f"<main><h1>Head</h1><article><p>{'The text. ' * 20}</p></article>{cards}</main>") == "Head\n\n" + ("The text. " * 20).strip()
    assert html_extract.extract("<head><title>T</title>Loose text<p>and more") == "Loose text\n\nand more"
    assert html_extract.extract("<form id=page><div>" + "word " * 40 + "</div></form>") == ("word " * 40).strip()


@pytest.mark.parametrize(
    "piece", ["<p class=\"x>a</p>", "</div></b></p>", "<div>a", "<b>x</i>", "<", "<!--", "<i><li>a<p>b", "<title>", "<b><div></b>", "&#x", "<a href='"]
)
def test_html_linear(piece):
    import time

    took = []
    for n in (4000, 16000):
        began = time.process_time()
        html_extract.extract("<article>" + piece * n)
        took.append(time.process_time() - began)
    assert took[1] < 12 * took[0] + 0.3


def test_html_table(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<p>Hello"), (None, "v", "<p>Hello"), (3, "w", "<p>" + "x " * 300_000 + "</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_extract.report(pages).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, 5, 5, 599_999] and {r["text"] for r in got if r["page_id"] is None} == {"Hello"}
    assert html_extract.report(pages.limit(0)).count() == 0
    clash = pages.withColumn("text", F.lit(1)).withColumn("Text_", F.lit(2))
    found, name = html_extract.extract_pages(clash)
    assert found.columns[:5] == clash.columns and name != "text"


def test_quality_brute():
    rng = random.Random(6)
    space = " \t\n\x0b\x0c\r"
    for _ in range(300):
        text = "".join(rng.choices(["a", "b", "ab", "#", "$x", "é", "中", " ", " ", "\n", "\t", "\x0c", "\xa0"], k=rng.randrange(60)))
        ws = [w for w in re.split(f"[{space}]+", text) if w]
        lines = [x for x in text.split("\n") if x.strip(space)]
        hit = {i for i in range(len(ws) - 2) for j in range(len(ws) - 2) if i != j and ws[i : i + 3] == ws[j : j + 3]}
        covered = {k for i in hit for k in (i, i + 1, i + 2)}
        wanted = (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))
        assert quality.base_counts(text.encode()) == wanted, text


def test_quality_pieces(monkeypatch):
    """A text that is hashed in pieces has the n-grams of the whole."""
    rng = random.Random(7)
    text = "".join("".join(rng.choices("abcdé", k=rng.randrange(1, 9))) + rng.choice([" ", "  ", "\n", " \t "]) for _ in range(1500)).encode()
    whole = quality.features([text, None])
    monkeypatch.setattr(quality, "PIECE", 333)
    assert all(np.array_equal(a, b) for x, y in zip(whole, quality.features([text, None])) for a, b in zip(x, y))


def test_quality_edges(spark, odd, empty, labels):
    assert quality.report(empty, labels).count() == 0
    clash = odd.withColumn("kept", F.lit(1)).withColumn("n_words", F.lit(2))
    assert quality.judge(clash, None)[0].columns[:4] == clash.columns


def test_language_scripts(spark):
    """Letters of other scripts have places of their own; signs and numbers are no letters."""
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("привет мир друзья мои", "ru"), ("добрый день всем вам", "ru"), ("γεια σου κόσμε φίλε", "el"), ("καλημέρα σε όλους σας", "el")] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["lang"] == r["lang_pred"] for r in got)
    assert len(set(langid.symbols("абвгдежзийклмнопрстуфхцчшщъыьэюя").tolist())) > 28
    odd = spark.createDataFrame([(1, "²½Ⅷ① 12 !?", "x"), (2, "\U0001f600", "x")], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in langid.identify(odd, langid.train(docs))[0].collect()} == {"und"}
    clash = docs.withColumn("score", F.lit(1))
    assert langid.identify(clash, langid.train(docs))[0].columns[:4] == clash.columns


def test_text_ids(spark):
    """Ids may be texts."""
    rows = [(f"d{i}", "Common line\n" + " ".join(f"w{i}{k}" for k in range(60))) for i in range(15)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    marks = spark.createDataFrame([(f"d{i}", i % 2, i % 2) for i in range(15)], "doc_id string, quality int, toxic int")
    assert {r["n_dropped"] for r in line_dedup.report(docs).collect()} == {1}
    assert line_dedup.dedup_lines(docs).where("text like 'Common%'").count() == 1
    assert quality.report(docs, marks).count() == toxicity.report(docs, marks).count() == 15
    assert simhash.dedup(docs).count() == 15


def test_line_dedup_one_document(spark):
    """A line that one document repeats very often counts once, also where its rows are cut over partitions."""
    rows = [(None, "x\n" * 3000)] + [(i, f"x\ny{i}") for i in range(8)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert line_dedup.report(docs).agg(F.sum("n_dropped")).first()[0] == 0  # nine documents
    more = docs.unionByName(spark.createDataFrame([(99, "X ")], SCHEMA))
    assert line_dedup.report(more).agg(F.sum("n_dropped")).first()[0] == 3009


def test_simhash_large_groups(spark, monkeypatch):
    """Components and buckets that are cut into pairs of blocks give what whole ones give."""
    rng = random.Random(14)
    rows = copies(rng, 40, 0.8, 0.9)
    base = rows[0][1].split()
    rows += [(1000 + i, " ".join([*base[:-1], f"tail{i}"])) for i in range(60)]
    whole = sorted(r["doc_id"] for r in simhash.dedup(spark.createDataFrame(rows, SCHEMA)).collect())
    monkeypatch.setattr(simhash, "GROUP", 7)
    monkeypatch.setattr(simhash, "BUCKET", 16)
    assert sorted(r["doc_id"] for r in simhash.dedup(spark.createDataFrame(rows, SCHEMA)).collect()) == whole


def test_toxicity_fit():
    """Expectation maximisation against brute force: no single rate can be moved to a greater likelihood."""
    rng = np.random.default_rng(5)
    text_of, feature = rng.integers(0, 30, 200), rng.integers(0, 6, 200)
    n, labels = rng.integers(1, 4, 200).astype(float), (np.arange(30) % 2 == 0).astype(np.int64)
    rates = toxicity.fit(text_of, labels, feature, n, steps=3000)

    def likelihood(r: dict) -> float:
        left = np.bincount(text_of, weights=n * np.array([r.get(int(f), 0.0) for f in feature]), minlength=30)
        good = np.where(labels == 1, np.log(np.maximum(-np.expm1(-left), 1e-12)), -left).sum()
        return good - toxicity.PRIOR * sum(r.values())

    best = likelihood(rates)
    for f in rates:
        for step in (0.9, 1.1):
            assert likelihood(rates | {f: rates[f] * step}) <= best + 1e-6


def test_toxicity(spark, odd, empty, labels):
    rng = random.Random(8)
    filler = [f"w{i}" for i in range(300)]
    rows = [(i, ". ".join(" ".join(rng.choices(filler, k=8)) for _ in range(5)) + (". you nasty brute" if i % 4 == 0 else ".")) for i in range(400)]
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = toxicity.report(docs, marks).where("held_out").collect()
    assert all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in got) and len(got) > 50
    found, name = toxicity.offending(docs.where("doc_id = 8"), toxicity.train(docs, marks))
    assert [rows[8][1][s["start"] : s["end"]].strip() for s in found.first()[name]] == ["you nasty brute"]
    assert {r["score"] for r in toxicity.report(odd, labels).collect()} == {0.0}
    assert toxicity.reject_toxic(odd, labels).columns == odd.columns
    assert toxicity.report(empty, labels).count() == 0


def test_toxicity_repeated(spark):
    """A sentence that is toxic in different texts is learnt; what only copies and near-copies of one text hold is not."""
    rng = random.Random(9)
    neutral = lambda: ". ".join(" ".join(f"w{rng.randrange(300)}" for _ in range(8)) for _ in range(5))
    one = neutral() + ". rare unique zebra. you nasty brute. "
    toxic = [neutral() + ". you nasty brute" for _ in range(60)] + [one] * 15 + [one + f"{i}" for i in range(15)]
    texts = toxic + [neutral() for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    marks = spark.createDataFrame([(i, int(i < len(toxic))) for i in range(len(texts))], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    assert model.score(b"you nasty brute") >= toxicity.THRESHOLD
    assert model.score(b"rare unique zebra") == 0.0


def test_toxicity_long_texts(spark, sf_dir):
    """Neutral text of any length scores zero; held-out recall is what the README says at least."""
    from corvane.llm.common import held_out

    big = sf_dir.replace("sf0.001", "sf0.01")
    docs, marks = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, marks)
    rows = docs.join(marks, "doc_id").where(held_out("doc_id")).select("text", "toxic").collect()
    hits = [model.score((r["text"] or "").encode()) >= toxicity.THRESHOLD for r in rows]
    toxic = [h for h, r in zip(hits, rows) if r["toxic"] == 1]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(h for h, r in zip(hits, rows) if r["toxic"] == 0) <= 2
    neutral = [ws for r in rows if r["toxic"] == 0 for ws in toxicity.sentences((r["text"] or "").encode()) if not model.rate(ws)]
    long = b". ".join(b" ".join(neutral[i % len(neutral)]) for i in range(10_000))
    assert len(toxicity.sentences(long)) == 10_000 and model.score(long) == 0.0


def brute_documents(raw: bytes, dtype: str, end: int) -> list[tuple[int, int, bool]]:
    """(ordinal, tokens, closed) of a flat file."""
    ids = np.frombuffer(raw, dtype=dtype).tolist()
    out, n = [], 0
    for x in ids:
        if x == end:
            out.append((len(out), n, True))
        n = 0 if x == end else n + 1
    return out + [(len(out), n, False)] * (n > 0)


@pytest.mark.parametrize("dtype, end", [("<u2", 9), ("<u2", 2570), ("<u4", 10 << 24), ("<u4", 255)])
def test_token_scan(spark, tmp_path, dtype, end):
    """Ranges are cut at line feeds anywhere in an id; the end id itself may hold some."""
    rng = random.Random(9)
    streams = {}
    for k in range(6):
        ids = [x for _ in range(rng.choice([0, 1, 60, 300])) for x in [*rng.choices([10, 2560, 2570, 266, 7, 65535], k=rng.choice([0, 1, 5, 40])), end]]
        ids += rng.choices([10, 2570, 7], k=rng.randrange(4))
        streams[f"f{k}.bin"] = np.array([x for x in ids], dtype=dtype).tobytes()
        (tmp_path / f"f{k}.bin").write_bytes(streams[f"f{k}.bin"])
    for size, block in ((2000, 7), (1 << 20, 4096)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = token_count.documents(spark, str(tmp_path / "*.bin"), end, dtype, block).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        for name, raw in streams.items():
            got = sorted((r["ordinal"], r["n_tokens"], r["closed"]) for r in rows if r["file"].endswith(name))
            assert got == brute_documents(raw, dtype, end), (name, size)


def test_token_scan_odd(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(np.array([1, 2, 9, 9, 3], dtype="<u2").tobytes() + b"\n")
    (tmp_path / "b.bin").write_bytes(b"")
    got = token_count.documents(spark, str(tmp_path / "*.bin"), end_id=9).orderBy("ordinal").collect()
    assert [(r["n_tokens"], r["closed"]) for r in got] == [(2, True), (0, True), (1, False)]
    assert [(r["n_documents"], r["n_tokens"]) for r in token_count.totals(spark, str(tmp_path / "a.bin"), end_id=9).collect()] == [(2, 3)]
    (tmp_path / "c.bin").write_bytes(b"\1\0\2")
    with pytest.raises(Exception, match="whole ids"):
        token_count.documents(spark, str(tmp_path / "c.bin"), end_id=9).collect()


def test_token_counts(spark, odd, empty):
    """The query's counts are the tokenizer's."""
    rows = token_count.report(odd.repartition(3)).collect()
    own = packing.Encoder(packing.vocabulary_path(), specials=False)
    key = lambda x: (x[0] is None, x)
    wanted = sorted(((i, len(own.whole((t or "").encode())) // 4) for i, t in ODD), key=key)
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in rows), key=key) == wanted
    assert len({(r["file"], r["ordinal"]) for r in rows}) == len(ODD)
    assert token_count.report(empty).count() == 0
    clash = odd.select(F.col("doc_id").cast("string").alias("doc_id"), "text").withColumn("part", F.lit(1)).withColumn("kind", F.lit(2))
    assert token_count.report(clash).where("doc_id = '8'").count() == 1


def brute_components(sets: list[set]) -> list[int]:
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


def test_pipeline(spark, sf_dir):
    """Each stage on its own input against brute force."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marks, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)

    def step(name, rows):
        frame = stages[name](spark, rows, sf_dir)
        assert name == "packing" or frame.columns == columns
        return corpus_pipeline.written(frame, f"test-{name}")

    def texts(frame):
        return {r["doc_id"]: r["text"] for r in frame.collect()}

    clean = step("toxicity", docs)
    model = toxicity.train(docs, marks)
    before, after = texts(docs), texts(clean)
    assert set(after) == {i for i, t in before.items() if model is None or model.score((t or "").encode()) < toxicity.THRESHOLD}

    lines = step("line_dedup", clean)
    key = lambda x: "".join(c.lower() if c < "\x80" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    held: dict = {}
    for i, t in after.items():
        for x in (t or "").split("\n"):
            if key(x):
                held.setdefault(key(x), set()).add(i)
    many = {k for k, v in held.items() if len(v) >= 10}
    total = {k: 0 for k in many}
    for i, t in texts(lines).items():
        own = (t or "").split("\n")
        for x in own:
            if key(x) in many:
                total[key(x)] += 1
        assert [x for x in own if key(x) not in many] == [x for x in (after[i] or "").split("\n") if key(x) not in many] or not after[i]
    assert set(total.values()) <= {1}

    alone = step("simhash_near_dedup", lines)
    ids = sorted(texts(lines))
    sets, own_text = [], texts(lines)
    for i in ids:
        ws = simhash.folded_words((own_text[i] or "").encode())
        sets.append({tuple(ws[k : k + 5]) for k in range(max(len(ws) - 4, 1))} if ws else {()})
    group = brute_components(sets)
    assert sorted(texts(alone)) == sorted(ids[k] for k in sorted(set(group)))

    cut = step("decontamination", alone)
    windows = {tuple(w[k : k + 10]) if len(w) >= 10 else tuple(w) for r in items.collect() for w in [decontaminate.words((r["text"] or "").encode())] if w for k in range(max(len(w) - 9, 1))}
    sizes = {len(w) for w in windows}

    def covered(t):
        ws = decontaminate.words((t or "").encode())
        return ws, {x for n in sizes for k in range(len(ws) - n + 1) if tuple(ws[k : k + n]) in windows for x in range(k, k + n)}

    kept = {}
    for i, t in texts(alone).items():
        ws, hit = covered(t)
        if 2 * len(hit) <= len(ws):
            kept[i] = [w for k, w in enumerate(ws) if k not in hit]
    assert {i: decontaminate.words((t or "").encode()) for i, t in texts(cut).items()} == kept

    packed = stages["packing"](spark, cut, sf_dir).collect()
    own = packing.Encoder(packing.vocabulary_path())
    lengths: dict = {}
    for r in packed:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == {i: len(own.whole((t or "").encode())) // 4 + 1 for i, t in texts(cut).items()}


def shared(spark) -> set[str]:
    return set(os.listdir(common.shared_dir(spark).removeprefix("file://")))


def test_scratch(spark):
    """Scopes that hold the same tables end each for itself, and leave alone what another thread writes."""
    before, outer, inner = shared(spark), None, None
    write = lambda name: common.written(spark.range(3), name)
    with common.scratch(lambda: outer):
        with common.scratch(lambda: inner):
            write("a")
            inner = write("b")
        assert inner.count() == 3 and {x[0] for x in shared(spark) - before} == {"b"}
        with ThreadPoolExecutor(1) as pool:
            other = pool.submit(write, "c").result()
        outer = write("d")
    assert outer.count() == other.count() == 3 and {x[0] for x in shared(spark) - before} == {"c", "d"}
    with pytest.raises(ZeroDivisionError), common.scratch(lambda: None):
        write("e")
        1 / 0
    assert {x[0] for x in shared(spark) - before} == {"c", "d"}


def test_pipeline_run(spark, tmp_path):
    """The query is its stages one after another, on odd rows and without rows, and leaves its result alone in the shared folder."""
    import corpus_pipeline

    passage = " ".join(f"q{k}" for k in range(12))
    own = [(20 + i, f"Shared line\n{' '.join(f'd{i}w{k}' for k in range(30))}\n{passage if i == 3 else 'tail'}") for i in range(12)]
    kind = "doc_id long, text string, lang string, source string, n_chars int"
    for rows in ([(i, t, "en", "web", len(t or "")) for i, t in [*ODD, *own, (40, own[0][1])]], []):
        at = str(tmp_path / str(len(rows)))
        spark.createDataFrame(rows, kind).repartition(3).write.parquet(f"{at}/documents.parquet")
        spark.createDataFrame([(1, None, 1), (20, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
        spark.createDataFrame([("b", passage), ("n", None)], "item_id string, text string").write.parquet(f"{at}/benchmark.parquet")
        stage = spark.read.parquet(f"{at}/documents.parquet")
        for name, f in corpus_pipeline.STAGES:
            stage = common.written(f(spark, stage, at), f"test-{name}")
        before = shared(spark)
        got = corpus_pipeline.run(spark, at)
        assert [x.rsplit("-", 1)[0] for x in shared(spark) - before] == ["pipeline-packing"]
        columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
        wanted, found = (sorted(map(tuple, x.select(columns).collect()), key=str) for x in (stage, got))
        assert found == wanted and got.columns == [*columns, "sequence_id", "offset"]
        assert {r[0] for r in found} == ({1, 4, None, 7, 8, *range(20, 32)} if rows else set())


def test_simhash_blocks_of_group(spark, monkeypatch):
    """The texts of a cut component's first block are no group of their own."""
    rng = random.Random(15)
    rows = []
    for k in range(5):
        base = [f"b{rng.randrange(10**6)}" for _ in range(60)]
        rows += [(1000 * k + i, " ".join([*base, f"tail{i}"])) for i in range(30)]
    monkeypatch.setattr(simhash, "GROUP", 7)
    assert sorted(r["doc_id"] for r in simhash.dedup(spark.createDataFrame(rows, SCHEMA)).collect()) == [1000 * k for k in range(5)]

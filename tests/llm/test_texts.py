"""Operators on single texts: quality rules, secrets, token counts, personal data."""

import re
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from curbflow.llm import mixing, pii, quality, queries, secrets, tokens, trigrams


def listed(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def texts(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


# quality rules


def test_quality_counts_are_the_plain_ones(spark, small):
    by_id = texts(spark, small)
    rows = queries.op2_quality_rules(spark, small).collect()
    assert len(rows) == len(by_id)
    for r in rows:
        want = brute.quality(by_id[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed
        assert r.kept == (not failed and r.score >= quality.THRESHOLD)


def test_quality_score_is_the_plain_ratio(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    trusted = {r.doc_id for r in quality.trusted_ids(labels).collect()}
    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    grams = {}
    for r in docs.collect():
        ids, seen = quality._ids((r.text or "").encode().split())
        grams[r.doc_id] = quality._grams(ids, seen, quality.BUCKETS).astype(int) if len(ids) else []
        for b in grams[r.doc_id]:
            raw[b] += 1
            target[b] += r.doc_id in trusted
    share = (raw + 1) / (raw.sum() + quality.BUCKETS)
    ratio = np.log((target + quality.PRIOR * share) / (target.sum() + quality.PRIOR) / share)
    for r in quality.judged(docs, quality.trusted_ids(labels)).collect():
        if len(grams[r.doc_id]):
            assert r.verdict.score == pytest.approx(ratio[grams[r.doc_id]].mean(), abs=1e-9)


def test_quality_separates_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op2_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    got = {r.quality: r for r in rows.groupBy("quality").agg(
        F.count_if("kept").alias("kept"), F.count_if(F.col("n_words") >= 50).alias("n")).collect()}
    assert got[1].kept >= 0.98 * got[1].n
    assert got[0].kept <= 0.05 * got[0].n


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_quality_keeps_good_documents_it_was_not_fitted_on(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").select("doc_id", "text")
    good = quality.trusted_ids(spark.read.parquet(f"/root/testdata/{size}/labels.parquet"))
    held = quality.judged(docs, good.where("doc_id % 10 <> 3")).join(good.where("doc_id % 10 = 3"), "doc_id")
    n, kept = held.where("not verdict.base_failed").agg(F.count("*"), F.count_if("verdict.kept")).first()
    assert n and kept >= 0.96 * n


def test_quality_odd_rows(spark, odd, none):
    rows = quality.judged(odd, odd.select("doc_id").where("doc_id = 8")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        v = r.verdict
        assert (v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words) == brute.quality(r.text)
    assert quality.judged(odd, None).where("verdict.score is not null").isEmpty()
    assert quality.keep_good(odd, None).columns == odd.columns
    assert quality.judged(none, none.select("doc_id")).isEmpty()
    assert quality.keep_good(none, None).isEmpty()
    with pytest.raises(ValueError, match="already"):
        quality.judged(odd, None, "Lang")


def test_many_distinct_words_do_not_overflow():
    ids = np.concatenate([np.arange(1 << 20), np.arange(1 << 20)])
    assert quality._repeated(ids, 1 << 20) == 2 << 20
    assert quality._repeated(np.arange(1 << 21), 1 << 21) == 0


# secrets


def test_secret_spans_are_the_plain_ones(spark, small):
    by_id = texts(spark, small)
    for r in queries.op3_secret_scan(spark, small).collect():
        want = brute.secrets(by_id[r.doc_id])
        assert r.base_sha256 == brute.sha(listed(want))
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for x, _, _ in want) for k in brute.BASE_SECRETS]


def test_secret_odd_rows(spark, odd, none):
    more = spark.createDataFrame(
        [("PASSWORD: 'abc' secret=abcdefgh APIKEY=\"x_y-z.1234\" paſſword=123456789 api-key=12345678",),
         ("é😀 ghp_" + "a1" * 20 + " -----BEGIN RSA PRIVATE KEY----- xoxb-12345678901 " + "deadbeef" * 5,)], "text string")
    rows = secrets.scanned(odd.select("text").union(more)).collect()
    for r in rows:
        assert [tuple(s) for s in r.secrets if s.kind in secrets.BASE] == brute.secrets(r.text)
    assert {s.kind for s in rows[-1].secrets} == {"code_host", "private_key", "chat_hook", "hex"}
    assert secrets.scanned(none).isEmpty()


def test_long_text_is_indexed_in_pieces(monkeypatch):
    monkeypatch.setattr(secrets, "PIECE_BYTES", 50)
    rules, at = secrets.RULES, 0
    asked = [trigrams.query_of(r.pattern) for r in rules]
    for at in range(60):
        text = "x" * at + "AKIA" + "B" * 20 + "y" * 90
        assert secrets._scan(["", text, "AKI A"], rules, asked) == [[], [("access", at, at + 24)], []]


@pytest.mark.parametrize("pattern, text", [
    ("abc|abd", "xabdx"), ("(foo|ba[rz])qux", "bazqux"), ("a?bcd", "bcd"), ("(abc)+d", "abcabcd"), ("x{3}y", "xxxy"),
    ("(?i:Token)=", "tOkEN="), ("a.c", "abc"), ("[^a]bcd", "zbcd"), ("ab(c|d|e)?fgh", "abfgh"), ("(ab|c+)def", "ccdef"),
])
def test_trigram_queries_never_exclude_a_match(pattern, text):
    keys = secrets._index([text.lower().encode()])
    assert secrets._candidates(trigrams.query_of(pattern), keys, 1).all()


def test_trigram_queries_exclude():
    assert trigrams.query_of("[0-9a-f]{32,}") is True
    keys = secrets._index([b"pass word", b"akia", b"say password"])
    assert secrets._candidates(trigrams.query_of("(?i:password|passwd)"), keys, 3).tolist() == [False, False, True]


def test_index_table_gives_candidates(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    index = secrets.postings(docs)
    for rule in secrets.RULES[:2]:
        got = {r.doc_id for r in secrets.candidates(index, rule.pattern).collect()}
        want = {r.doc_id for r in docs.collect() if any(rule.spans(r.text or ""))}
        assert want <= got and len(got) < docs.count()
    assert secrets.candidates(index, secrets.RULES[2].pattern) is None


# token counts


def _unigram(pieces):
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    extra = [("<unk>", -1.0)] + [(f"<0x{i:02X}>", -2.0) for i in range(256)]
    tokenizer = Tokenizer(models.Unigram(extra + pieces, unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(r"[\x20\x09-\x0D]+"), "removed"),
        pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True),
    ])
    return tokenizer


def test_token_counts_are_the_tokenizers(spark, small):
    pieces = tokens.ranked_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    tokenizer, by_id = _unigram(pieces), texts(spark, small)
    for r in queries.op6_token_counts(spark, small).collect():
        assert r.n_words == len(brute.words(by_id[r.doc_id]))
        assert r.n_tokens == len(tokenizer.encode(by_id[r.doc_id] or "", add_special_tokens=False).ids)


def test_token_ties_follow_the_tokenizer():
    pieces = [(p, -1.0 * len(p)) for p in ("▁", "a", "b", "ab", "ba", "aba", "▁a", "▁ab", "bab")]
    tokenizer, counter = _unigram(pieces), tokens.Counter(pieces)
    for n in range(1, 9):
        for k in range(1 << n):
            word = "".join("ab"[k >> i & 1] for i in range(n)) + ("é" if k % 3 == 0 else "")
            assert counter.count(word)[1] == len(tokenizer.encode(word, add_special_tokens=False).ids), word


def test_token_odd_rows(spark, odd, none):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = tokens.counted(odd, path).collect()
    assert len(rows) == odd.count()
    assert all((r.tokens.n_tokens == 0) == (r.tokens.n_words == 0) for r in rows)
    assert tokens.counted(none, path).isEmpty()


# personal data


def test_pii_spans_are_the_plain_ones(spark, small):
    by_id = texts(spark, small)
    for r in queries.op7_pii_disclosure(spark, small).collect():
        want = brute.pii(by_id[r.doc_id])
        assert r.base_sha256 == brute.sha(listed(want))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in want) for k in brute.BASE_PII]


def test_pii_hard_texts(spark):
    hard = [
        "a@b.c_x@d.e", "a@b.c@d.e", "1.2.3.4.5.6.7.8 300.1.1.1 0001.002.3.4", "1.2.3.4" * 3, "a@b@c.d a@b. @x.y ..@a.b",
        "4111-1111-1111-1111, 4111 1111 1111 1112 12345678901234567890", "x+12345678 +1234567890123456 +1   2 (3)4567.8",
        " ".join(f"u{i}@h.com" for i in range(200)), "é" * 90 + "😀 a@b.co" + "é" * 90,
    ]
    docs = spark.createDataFrame(list(enumerate(hard)), "doc_id long, text string")
    for r in pii.all_spans(docs).collect():
        assert [tuple(s) for s in r.spans if s.kind != "term"] == brute.pii(hard[r.doc_id])


def test_pii_odd_rows(spark, odd, none):
    rows = pii.all_spans(odd).collect()
    assert len(rows) == odd.count()
    clean = pii.sanitised(odd)
    assert clean.columns == odd.columns
    got = {r.doc_id: r.text for r in clean.collect()}
    assert len(got) == 12 and clean.count() == odd.count()
    assert got[0] is None and got[1] == "" and got[9] == "x" * 50_000
    # words that stand nowhere but beside one entity tell it in a table of any size
    assert got[6] == "é😀 [EMAIL] [IP]  [PHONE], [CARD] : "
    assert got[8].split() == ["[EMAIL]", "="]
    assert pii.all_spans(none).isEmpty() and pii.sanitised(none).isEmpty()


LOOSE = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
LETTER = rf"[[\p{{L}}\p{{M}}\p{{N}}]--[{LOOSE}]]"


def terms_of(text):
    """Every term with its place, by pattern alone."""
    out = []
    for m in regex.finditer(rf"(?V1)[{LOOSE}]++|{LETTER}{{2,}}+", text):
        if regex.match(f"(?V1)[{LOOSE}]", m[0]):
            out += [(m[0][i : i + 2].lower(), m.start() + i, m.start() + i + len(m[0][i : i + 2])) for i in range(max(1, len(m[0]) - 1))]
        else:
            out.append((m[0].lower(), *m.span()))
    return out


def term_spans(docs):
    """Spans of revealing terms of every document, by counting over all of them."""
    held, n_t, n_c, near = {}, Counter(), Counter(), defaultdict(list)
    for doc, text in docs.items():
        spans = brute.pii(text)
        blank = text or ""
        for _, a, b in spans:
            blank = blank[:a] + " " * (b - a) + blank[b:]
        n_t.update({t for t, _, _ in terms_of(blank)})
        if not spans:
            continue
        names = {(a, b): k + ":" + ((text[a:b].lower() if k == "email" else text[a:b]) if k in ("email", "ip") else re.sub("[^0-9]", "", text[a:b])) for k, a, b in spans}
        held[doc] = (blank, set(names.values()))
        n_c.update(set(names.values()))
        pairs = set()
        for (a, b), entity in names.items():
            left, right = blank[max(0, a - 81) : a], blank[b : b + 81]
            left = regex.sub(f"(?V1)^{LETTER}+", "", left) if len(left) > 80 else left
            right = regex.sub(f"(?V1){LETTER}+$", "", right) if len(right) > 80 else right
            pairs |= {(entity, t) for t, _, _ in terms_of(left + " " + right)}
        for pair in pairs:
            near[pair].append(text)
    n, reveals = len(docs), defaultdict(set)
    for (entity, term), found in near.items():
        share, seen = n_c[entity] / n, len(set(found))
        beside = (seen * len(found) / n_t[term] + share) / (seen + 1)
        if beside >= 0.5 and beside >= 2 * share:
            reveals[entity].add(term)
    return {d: sorted((a, b) for t, a, b in terms_of(x) if any(t in reveals[e] for e in entities)) for d, (x, entities) in held.items()}


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_term_spans_of_whole_tables(spark, size):
    sf = f"/root/testdata/{size}"
    want = term_spans(texts(spark, sf))
    got = {r.doc_id: [tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x.startswith("term:")] for r in queries.op7_pii_disclosure(spark, sf).collect()}
    assert sum(map(len, want.values())) > 50
    assert all(got[d] == want.get(d, []) for d in got)


def test_terms_that_reveal_an_entity_go(spark):
    rows = [(i, f"the firm zorblax wrote to boss@zorb.example and more number{i}") for i in range(4)]
    rows += [(10 + i, f"the firm wrote to you and more things come number{i}") for i in range(60)]
    rows += [(100 + i, "more mail to boss@other.example by the firm") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.all_spans(docs).collect()}
    text = dict(rows)
    terms = {text[d][s.start : s.end] for d, found in spans.items() for s in found if s.kind == "term"}
    assert terms == {"zorblax", "mail", "by"}  # the last two stand beside the other entity alone, copies of one text
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert clean[0] == "the firm  wrote to [EMAIL] and more number0"
    assert clean[10] == text[10] and clean[100] == "more  to [EMAIL]  the firm"


def test_a_term_of_one_text_can_reveal_its_entity(spark):
    rows = [(0, "the firm zorblax wrote to boss@zorb.example and more")]
    rows += [(1 + i, f"the firm wrote to you and more things come on day {i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert clean[0] == "the firm  wrote to [EMAIL] and more"
    few = {r.doc_id: r.text for r in pii.sanitised(docs.where("doc_id < 100")).collect()}
    assert few[0] == "the firm  wrote to [EMAIL] and more"  # the rule is the same for tables of any size


def test_revealing_terms_go_from_the_whole_text(spark):
    gap = " and more things come" * 10
    rows = [(0, f"(zorblax) x@a.example y@b.example{gap}, O'Qua-Bo's agent7 Zorblax's \"zorblax\" zorblax-like. x@a.example by Qua")]
    rows += [(1, f"田中太郎 z@c.example{gap} 田中太郎"), (2, f"qua{gap}"), (3, f"Li w@d.example{gap} li")]
    rows += [(10 + i, f"the like things come and more by {i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    # qua stands in another text too, so one text beside x@a.example says too little
    assert clean[0] == f"() [EMAIL] [EMAIL]{gap}, O'Qua-'s  's \"\" -like. [EMAIL] by Qua"
    assert clean[1] == f" [EMAIL]{gap} " and clean[2] == f"qua{gap}" and clean[3] == f" [EMAIL]{gap} "
    many = spark.createDataFrame(
        [(i, f"the like zorblax{gap} by boss@zorb.example{gap} zorblax number{i}") for i in range(4)]
        + [(4 + i, f"the zorblax like: boss@zorb.example{gap} zorblax number{i}") for i in range(20)]
        + [(30, f"only zorblax{gap}")] + rows[30:400],
        "doc_id long, text string",
    )
    clean = {r.doc_id: r.text for r in pii.sanitised(many).collect()}
    assert clean[0] == f"the like [TERM]{gap} by [EMAIL]{gap} [TERM] number0"
    assert clean[30] == f"only zorblax{gap}"  # the identifier is nowhere in the output


def test_blanked_keeps_places(spark):
    docs = spark.createDataFrame([(1, "é😀 +4111111111111111 a@1.2.3.4 é")], "doc_id long, text string")
    text = docs.select("text", pii.base_spans(F.col("text")).alias("s")).select(pii.blanked(F.col("text"), F.col("s"))).first()[0]
    assert text == "é😀 +" + " " * 27 + "é"


def test_pii_plan_has_no_python(spark, odd):
    plan = pii.sanitised(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


# mixing


def raked(cells, targets, rounds=400):
    """Cells {(source, lang, topic): weight} scaled to the targets per dimension, plainly."""
    total = sum(cells.values())
    w = {c: n / total for c, n in cells.items() if n}
    for _ in range(rounds):
        for axis, target in enumerate(targets):
            now = {}
            for c, x in w.items():
                now[c[axis]] = now.get(c[axis], 0) + x
            w = {c: x * target[c[axis]] / now[c[axis]] for c, x in w.items()}
    return w


def probabilities(rows, named=()):
    """Brute force of a whole table's probabilities from its words, for tempered targets."""
    cells = {}
    for r in rows:
        c = (r.source, r.lang, r.topic)
        cells[c] = cells.get(c, 0) + r.n_words
    power = {c: n**mixing.TEMPER for c, n in cells.items() if n}
    targets = []
    for axis in range(3):
        own = {}
        for c, x in power.items():
            own[c[axis]] = own.get(c[axis], 0) + x / sum(power.values())
        targets.append(own)
    w, total = raked(cells, targets), sum(cells.values())
    ratio = {c: x / (cells[c] / total) for c, x in w.items()}
    return {c: x / max(ratio.values()) for c, x in ratio.items()}, targets


def register(text):
    text = text or ""
    n, marks = max(1, len(text)), "#*$%&|<>{}[]=_/\\"
    if not brute.words(text):
        return "empty"
    if sum(c in "0123456789" for c in text) > 0.02 * n:
        return "figures"
    if sum(c in marks for c in text) > 0.05 * n:
        return "marks"
    return "list" if n < 60 * (text.count("\n") + 1) else "short" if n < 2000 else "long"


def test_mixing_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = {d: t for d, t in texts(spark, sf).items()}
    rows = queries.op9_raked_mixing(spark, sf).collect()
    assert {r.doc_id: (r.n_words, r.topic) for r in rows} == {d: (len(brute.words(t)), register(t)) for d, t in docs.items()}
    want, _ = probabilities(rows)
    assert all(abs(r.probability - want[r.source, r.lang, r.topic]) < 1e-6 for r in rows)
    decided = spark.read.parquet(f"{sf}/documents.parquet").selectExpr(
        "doc_id", "pmod(xxhash64(doc_id, coalesce(text, ''), 17), 9007199254740992) / 9007199254740992d AS draw"
    )
    draws = dict(map(tuple, decided.collect()))
    assert all(r.sampled == (draws[r.doc_id] < r.probability) for r in rows)
    assert 0 < sum(r.sampled for r in rows) < len(rows)


@pytest.mark.parametrize("few", [mixing.FEW, 10])
def test_mixing_rakes_every_of_many_sources(spark, few):
    rows = [(i, " ".join(["w"] * (5 + i * i % 37 + 300 * (i % 200 == 0))), ["en", "de", None][i % 3], f"s{i % 200}" if i % 200 else None) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = {k: k for k in mixing.NAMES}
    got = mixing.calibrated(docs, names, few=few).collect()
    want, targets = probabilities(got)
    assert len(targets[0]) == 200
    assert all(abs(r.probability - want[r.source, r.lang, r.topic]) < 1e-6 for r in got)
    total = sum(r.n_words * r.probability for r in got)
    for axis, d in enumerate(("source", "lang", "topic")):
        for name, share in targets[axis].items():
            assert abs(sum(r.n_words * r.probability for r in got if r[d] == name) / total - share) < 1e-6


def test_mixing_probabilities_meet_named_targets(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = {k: k for k in mixing.NAMES}
    targets = {"lang": {"en": 0.4, "de": 0.3, "fr": 0.2, "es": 0.1}}
    rows = mixing.calibrated(docs, names, targets).toPandas()
    weight = (rows.n_words * rows.probability).groupby(rows.lang).sum()
    assert (weight / weight.sum()).round(6).to_dict() == targets["lang"]
    assert rows.probability.max() == 1.0
    drawn = rows.sampled.mean()
    assert abs(drawn - rows.probability.mean()) < 0.05
    again = mixing.calibrated(docs.repartition(5), names, targets).where("sampled").count()
    assert again == rows.sampled.sum()


@pytest.mark.parametrize("few", [mixing.FEW, 0])
def test_mixing_refuses_targets_that_cannot_be_met(spark, few):
    docs = spark.createDataFrame([(1, "a b", "en", "x"), (2, "c d", "de", "y")], "doc_id long, text string, lang string, source string")
    names = {k: k for k in mixing.NAMES}
    with pytest.raises(ValueError, match="marginals"):
        mixing.rake(
            spark.createDataFrame([("=x", "=en", "=list", 0.5), ("=y", "=de", "=list", 0.5)], "source string, lang string, topic string, share double"),
            {
                "source": spark.createDataFrame([("=x", 0.9, 1.0), ("=y", 0.1, 1.0)], "source string, share double, factor double"),
                "lang": spark.createDataFrame([("=en", 0.5, 1.0), ("=de", 0.5, 1.0)], "lang string, share double, factor double"),
                "topic": spark.createDataFrame([("=list", 1.0, 1.0)], "topic string, share double, factor double"),
            },
            rounds=3, few=few,
        )
    with pytest.raises(ValueError, match="already"):
        mixing.calibrated(docs, names | {"topic": "LANG"})


def test_mixing_odd_rows(spark, odd, none):
    names = {"n_words": "n", "topic": "kind", "probability": "p", "sampled": "s"}
    rows = mixing.calibrated(odd, names).toPandas()
    assert len(rows) == odd.count() and rows.p.between(0, 1).all()
    assert set(rows[rows.text.isna() | (rows.text == " \t\n\x0b")].kind) == {"empty"}
    assert mixing.sample(odd).columns == odd.columns
    assert mixing.sample(none).isEmpty()
    silent = spark.createDataFrame([(1, None, None, None)], "doc_id long, text string, source string, lang string")
    assert mixing.sample(silent).count() == 1

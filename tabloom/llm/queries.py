"""One registered query per operator of this folder, over its whole tables, with checking SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import classifier as cl, conversations as cv, exact_dedup as ed, jaccard as jc, language as la, lexical as lx, mixing as mx, neighbours as nb, packing as pk, quality_rules as qr, repeats as rp, secrets as sc, token_counts as tc


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_suffix_dedup(spark, d):
    out = rp.remove_repeats(table(spark, d, "documents"))
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_token_counts(spark, d):
    return tc.count_tokens(table(spark, d, "documents"), ["doc_id"])


def op3_hilbert_packing(spark, d):
    return pk.pack(table(spark, d, "documents")).drop("ids")


def remainder(key: str, divisor: int):
    return F.crc32(F.col(key).cast("string")) % divisor


def op4_language_id(spark, d):
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return la.answer(table(spark, d, "documents"), remainder("doc_id", 4) != 2, [F.col("doc_id"), held])


def quality_model(spark, d):
    labels = table(spark, d, "labels").select("doc_id", "quality").where(remainder("doc_id", 5) != 0)
    return cl.fit(table(spark, d, "documents"), labels, label="quality")


def op7_quality_classifier(spark, d):
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    out = cl.score(table(spark, d, "documents"), quality_model(spark, d), [F.col("doc_id"), held])
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_secret_scan(spark, d):
    out = sc.find_secrets(table(spark, d, "documents"), ["doc_id"])
    base = [r.kind for r in sc.BASE_RULES]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return out.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(sc.digest(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        sc.digest(F.col("spans")).alias("spans"),
    )


def op6_ngram_jaccard(spark, d):
    return jc.jaccard_components(table(spark, d, "documents"))


def op8_permutation_search(spark, d):
    return nb.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_quality_rules(spark, d):
    wanted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = qr.quality_rules(table(spark, d, "documents"), ["doc_id"], features=wanted)
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return out.select("doc_id", *wanted, failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"))


def op10_source_mixing(spark, d):
    margins = {"source": F.col("source"), "lang": F.col("lang"), "topic": mx.topic(F.col("text"))}
    out = mx.mix(table(spark, d, "documents"), margins)
    return out.select(
        "doc.doc_id",
        *margins,
        F.col("tokens").alias("n_tokens"),
        F.round("cell_weight", 9).alias("cell_weight"),
        F.round("probability", 9).alias("probability"),
        "kept",
    )


def op11_exact_dedup(spark, d):
    return ed.copies(table(spark, d, "documents"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with the faults that the contract plants, by a hash of conversation and turn."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn"))) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).where("fault <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def op12_conversation_repair(spark, d):
    rows = table(spark, d, "conversations")
    found = cv.repair(damaged(rows))
    ids = rows.select(F.col("conv_id").alias("id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out = ids.join(found.summary(), F.col("id").eqNullSafe(F.col("key")), "left").drop("key")
    out = out.join(found.digests(), F.col("id").eqNullSafe(F.col("key")), "left")
    return out.select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_lexical_search(spark, d):
    return lx.ranked(table(spark, d, "documents"), table(spark, d, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_token_counts, op3_hilbert_packing, op4_language_id, op5_secret_scan, op6_ngram_jaccard, op7_quality_classifier,
    op8_permutation_search, op9_quality_rules, op10_source_mixing, op11_exact_dedup, op12_conversation_repair, op13_lexical_search,
)}

def _secrets_sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    each = " UNION ALL ".join(
        f"SELECT r, {i} AS number, {quote(x.kind)} AS kind, {x.least} AS least, string_split_regex(x, {quote(x.pattern)}) AS gaps, "
        f"regexp_extract_all(x, {quote(x.pattern)}, 0) AS hits, regexp_extract_all(x, {quote(x.pattern)}, {x.group}) AS vals FROM t"
        for i, x in enumerate(sc.RULES)
    )
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
e AS ({each}),
u AS (SELECT r, number, kind, least, unnest(generate_series(1, len(hits))) AS i, gaps, hits, vals FROM e WHERE len(hits) > 0),
l AS (SELECT r, number, kind, least, i, length(gaps[i]) AS gap, length(hits[i]) AS hit, length(vals[i]) AS val FROM u),
p AS (SELECT *, sum(gap + hit) OVER (PARTITION BY r, number ORDER BY i) AS stop FROM l),
s AS (SELECT r, number, kind, stop - hit AS start, kind || ':' || (stop - hit)::BIGINT || ':' || stop::BIGINT AS span FROM p WHERE val >= least),
g AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY start, number) FILTER (number < 3) AS base,
             string_agg(span, ',' ORDER BY start, number) AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g ON g.r = t.r"""


def _mixing_sql() -> str:
    names = ("source", "lang", "topic")
    goals = ", ".join(
        f"g_{m} AS (SELECT {m}, sum(tokens)::DOUBLE ** {mx.TEMPER} AS g FROM c GROUP BY {m}), "
        f"t_{m} AS (SELECT {m}, g / (SELECT sum(g) FROM g_{m}) AS t FROM g_{m})"
        for m in names
    )
    steps, last = [], "w"
    for k in range(mx.SWEEPS):
        for m in names:
            steps.append(
                f"{last}_ AS MATERIALIZED (SELECT x.* REPLACE (w * t / nullif(sum(w) OVER (PARTITION BY x.{m}), 0) AS w) "
                f"FROM {last} AS x JOIN t_{m} ON t_{m}.{m} = x.{m})".replace(f"{last}_ AS", f"w{k}{m} AS")
            )
            last = f"w{k}{m}"
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, coalesce(text, '') AS x FROM documents),
n AS (SELECT doc_id, source, lang, len(regexp_extract_all(x, '[^ \\t\\n\\x0B\\f\\r]+')) AS n_tokens,
  CASE WHEN (length(x) - length(replace(x, '|', ''))) * 40 > length(x) THEN 'table'
       WHEN (length(x) - length(regexp_replace(x, '[0-9]', '', 'g'))) * 20 > length(x) THEN 'figures'
       WHEN length(x) < 600 THEN 'note' WHEN length(x) < 3000 THEN 'article' ELSE 'book' END AS topic FROM d),
c AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens) AS tokens FROM n GROUP BY ALL),
{goals},
w AS (SELECT *, tokens::DOUBLE AS w FROM c),
{", ".join(steps)},
r AS (SELECT source, lang, topic, coalesce(w, 0) AS w, coalesce(w / nullif(tokens, 0), 0) AS ratio FROM {last}),
p AS (SELECT *, ratio / (SELECT max(ratio) FROM r) AS p FROM r)
SELECT n.doc_id, n.source, n.lang, n.topic, n_tokens::BIGINT AS n_tokens, round(w, 9) AS cell_weight, round(p, 9) AS probability,
       (('0x' || substr(md5(concat_ws('|', '17', 'mix', n.doc_id)), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE < p AS kept
FROM n JOIN p ON n.source = p.source AND n.lang = p.lang AND n.topic = p.topic"""


def _repair_sql() -> str:
    # per row and state of the form the least (cost, audit), with the repaired lines; states as in conversations.py
    far = "{'c': 1000000, 'a': '', 'r': ''}"
    made = {2: "user:", 3: "assistant:"}
    least = lambda *x: f"list_sort([{', '.join(x)}])[1]"
    grown = lambda s, c, a, r: f"{{'c': {s}.c + {c}, 'a': {s}.a || '{a}', 'r': {s}.r || {r}}}"
    line = lambda x: f"{x} || chr(10)"
    ins = lambda s, to: grown(s, 3, "I", line(f"'{made[to]}'"))

    def inserted(a: str) -> str:
        """Two rounds of insertions after the states a0..a3: 0, 1 and 3 to user, 2 to assistant."""
        one = f"{a}0 AS i0, {a}1 AS i1, {least(a + '2', ins(a + '0', 2), ins(a + '1', 2), ins(a + '3', 2))} AS i2, {a}3 AS j3, {a}2 AS j2"
        return f"i0, i1, i2, {least('j3', ins('i2', 3))} AS i3", one

    last, first = inserted("s")
    stay = lambda c: f"CASE WHEN fault IN ('blank', 'duplicate') THEN {far} ELSE {c} END"
    keep = lambda s, letter: f"CASE WHEN left(role, 1) = '{letter}' THEN {grown(s, '(CASE WHEN fault = ' + chr(39) + 'truncated' + chr(39) + ' THEN 3 ELSE 0 END)', 'K', line('role || chr(58) || text'))} ELSE {far} END"
    turn = lambda s, to: grown(s, "(CASE WHEN fault = 'truncated' THEN 6 ELSE 3 END)", "R", line(f"'{made[to]}' || text"))
    gone = lambda s: grown(s, 4, "D", "''")
    to_user = [x for s in ("i0", "i1", "i3") for x in (stay(keep(s, "u")), stay(turn(s, 2)))]
    step = ", ".join([
        f"{gone('i0')} AS s0",
        f"{least(gone('i1'), stay(keep('i0', 's')))} AS s1",
        f"{least(gone('i2'), *to_user)} AS s2",
        f"{least(gone('i3'), stay(keep('i2', 'a')), stay(turn('i2', 3)))} AS s3",
    ])
    return f"""
WITH RECURSIVE b AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, e: xor(xor(c, e) >> 1, 3988292384::BIGINT * (xor(c, e) & 1))), 4294967295::BIGINT) % 20 AS h
  FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
        CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS again FROM b WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 32), md5(text)) AS n,
        regexp_replace(text, '[ \t\n\x0B\f\r]+$', '') AS cut FROM d),
f AS (SELECT *, CASE WHEN cut = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
        WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS bad,
        count(*) OVER (PARTITION BY conv_id) AS total FROM o),
w AS (SELECT conv_id, 0::BIGINT AS n, max(total) AS total, {{'c': 0, 'a': '', 'r': ''}} AS s0, {far} AS s1, {far} AS s2, {far} AS s3 FROM f GROUP BY conv_id
  UNION ALL
  SELECT conv_id, n, total, {step}
  FROM (SELECT conv_id, n + 1 AS n, total, {last} FROM (SELECT conv_id, n, total, {first} FROM w WHERE n < total) AS x) AS y
  JOIN (SELECT conv_id AS conv, n AS at, role, text, fault FROM f) AS z ON z.conv IS NOT DISTINCT FROM y.conv_id AND z.at = y.n),
e AS (SELECT conv_id, {least('i0', 'i3')} AS best FROM (SELECT conv_id, {last} FROM (SELECT conv_id, {first} FROM w WHERE n = total) AS x) AS y),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (bad) AS illegal FROM f GROUP BY conv_id)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(left(best.r, length(best.r) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS i
LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM i.conv_id"""


ORACLE: dict[str, str] = {
    "op11_exact_dedup": """
SELECT doc_id, max(doc_id) OVER t AS keep_id, count(*) OVER t AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW t AS (PARTITION BY coalesce(text, ''))""",
    "op12_conversation_repair": _repair_sql(),
    "op13_lexical_search": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
s AS (SELECT count(*) AS N, sum(len(ws))::BIGINT AS L FROM d WHERE len(ws) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln(((2 * N + 2)::DOUBLE) / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, s),
q AS (SELECT i, item_id, term, count(*) AS often FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
m AS (SELECT r, doc_id, 75 + (25 * len(ws) * N) // L AS m FROM d, s WHERE len(ws) > 0),
x AS (SELECT i, item_id, r, sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score, any_value(doc_id) AS doc_id
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY i, item_id, r),
y AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM x WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM y WHERE rank <= 20""",
    "op10_source_mixing": _mixing_sql(),
    "op5_secret_scan": _secrets_sql(),
    "op6_ngram_jaccard": r"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS ws
       FROM documents),
g AS (SELECT r, array_to_string(ws, ' ') AS s FROM t WHERE len(ws) BETWEEN 1 AND 4
      UNION SELECT r, array_to_string(ws[i:i + 4], ' ') FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM t WHERE len(ws) >= 5)),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
links AS (SELECT a.r AS a, b.r AS b FROM g AS a JOIN g AS b ON a.s = b.s AND a.r <> b.r JOIN n AS na ON na.r = a.r JOIN n AS nb ON nb.r = b.r
          GROUP BY a.r, b.r, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
reach AS (SELECT r AS a, r AS b FROM t UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT x.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(y.doc_id) AS component_id
FROM reach JOIN t AS x ON x.r = reach.a JOIN t AS y ON y.r = reach.b LEFT JOIN n ON n.r = x.r GROUP BY x.r, x.doc_id""",
    "op9_quality_rules": r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
w AS (SELECT r, doc_id, x, regexp_extract_all(x, '[^ \t\n\x0B\f\r]+') AS ws,
             list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^ \t\n\x0B\f\r]')) AS ls FROM t),
i AS (SELECT r, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w WHERE len(ws) >= 8),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(ws[i:i + 7], ' ')) AS n FROM i),
p AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM h WHERE n > 1),
c AS (SELECT r, sum(least(8, i - coalesce(before, i - 8))) AS n FROM p GROUP BY r),
s AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             length(x) - length(regexp_replace(x, '[A-Z]', '', 'g')) AS n_capitals,
             len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
      FROM w LEFT JOIN c ON c.r = w.r)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed,
       NOT (n_words < 20 OR n_repeat_words * 100 > n_words * 30 OR n_symbols * 2 > n_words OR n_dup_lines > 3 AND n_dup_lines * 100 > n_lines * 30
            OR word_chars > n_words * 15 OR word_chars < n_words * 2 OR n_capitals * 2 > word_chars) AS kept
FROM s""",
}

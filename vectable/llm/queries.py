"""The queries of these operators over the given tables, and the SQL of those that SQL can state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.llm import decontamination, language, licences, lines, manifest, packing, polytope, pseudonyms, repeats, secrets, simhash, toxicity, variants
from vectable.plans.common import Catalog, table

catalog = Catalog()


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; NULL without an id."""
    return F.crc32(doc_id.cast("string")) % n


def held_out(n: int, fold: int) -> Column:
    return F.coalesce(remainder(F.col("doc_id"), n) == fold, F.lit(False)).alias("held_out")


@catalog.query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), lambda doc_id: remainder(doc_id, 5) != 0)
    found = toxicity.score(docs, model)
    return found.select("doc_id", held_out(5, 0), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@catalog.query()
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@catalog.query()
def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("vectable.pseudonym.key", "vectable")
    found = pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key)
    return found.select("doc_id", "text", F.array_join("pii", ",").alias("pii"), F.size("pii").alias("n_pii"))


@catalog.query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@catalog.query()
def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.find(table(spark, sf_dir, "documents"), inside_lines=True)


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


@catalog.query(
    r"WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents), "
    f"x AS (SELECT r, w, unnest(range(1, len(w) - {repeats.WINDOW} + 2)) AS i FROM d WHERE len(w) >= {repeats.WINDOW}), "
    f"h AS (SELECT r, i, md5(array_to_string(w[i:i + {repeats.WINDOW} - 1], ' ')) AS s FROM x), q AS (SELECT r, i FROM h QUALIFY count(*) OVER (PARTITION BY s) > 1), "
    f"g AS (SELECT DISTINCT r, i + k AS j FROM q, (SELECT unnest(range({repeats.WINDOW})) AS k)), n AS (SELECT r, count(*) AS n_removed FROM g GROUP BY r), "
    "t AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d), "
    "k AS (SELECT r, string_agg(word, ' ' ORDER BY j) AS kept FROM t ANTI JOIN g USING (r, j) GROUP BY r) "
    "SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN n USING (r) LEFT JOIN k USING (r)"
)
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def _cased(word: str) -> str:
    """A pattern for a word in either case, letter by letter."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


#: The base kinds without what other engines read differently: case flags beyond ASCII and lookbehind.
_PLAIN = {
    "assign": "(" + "|".join(_cased(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + r""")["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)""",
    "hex": "[0-9a-f]{24,}",
}


def _secret_sql() -> str:
    parts = []
    for place, rule in enumerate(secrets.RULES):
        pattern = _PLAIN.get(rule.kind, rule.pattern).replace("'", "''")
        parts.append(
            f"SELECT r, list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start, {place} AS place, '{rule.kind}' AS kind, "
            f"length(m[i]) AS n, length(g[i]) AS c FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS g, "
            f"string_split_regex(t, '{pattern}') AS p FROM d WHERE regexp_matches(t, '{pattern}')))"
        )
    least = "CASE kind " + " ".join(f"WHEN '{r.kind}' THEN {r.least}" for r in secrets.RULES) + " END"
    written = "coalesce(string_agg(kind || ':' || start || ':' || (start + n), ',' ORDER BY start, place){only}, '')"
    base = f" FILTER (WHERE place < {len(secrets.BASE)})"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)
    return (
        f"WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), s AS ({' UNION ALL '.join(parts)}), "
        f"k AS (SELECT r, start::BIGINT AS start, place, kind, n FROM s WHERE c >= {least}), "
        f"a AS (SELECT r, {counts}, {written.format(only=base)} AS base, {written.format(only='')} AS spans FROM k GROUP BY r) "
        "SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, "
        "sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (r)"
    )


@catalog.query(_secret_sql())
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s["place"] < len(secrets.BASE))
    counts = [count_of(spans, rule.kind).alias(f"n_{rule.kind}") for rule in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(secrets.written(base), 256).alias("base_sha256"), secrets.written(spans).alias("spans"))


@catalog.query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, "text", "lang", remainder(F.col("doc_id"), 3) != 1)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(3, 1), "lang_pred", "score", "ambiguous")


@catalog.query()
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@catalog.query(
    "WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v, label FROM embeddings), "
    "u AS (SELECT * FROM e WHERE label IS NOT NULL AND v IS NOT NULL AND list_bool_and(list_transform(v, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(v, lambda x: x <> 0))), "
    "p AS (SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r AND list_cosine_similarity(a.v, b.v) >= 0.93), "
    "c AS (SELECT r AS node, r AS seen FROM e UNION SELECT c.node, p.b FROM c JOIN p ON p.a = c.seen), "
    "m AS (SELECT node, min(vec_id) AS component_id FROM c JOIN e ON e.r = c.seen GROUP BY node), n AS (SELECT a AS r, count(*) AS n_links FROM p GROUP BY a) "
    "SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept FROM e JOIN m ON m.node = e.r LEFT JOIN n USING (r)"
)
def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polytope.near_duplicates(table(spark, sf_dir, "embeddings"))


@catalog.query(
    "WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents), "
    "x AS (SELECT r, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS j FROM d), "
    r"k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x), "
    f"s AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= {lines.LEAST_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) >= {lines.LEAST_DOCUMENTS}), "
    "g AS (SELECT r, j FROM k JOIN s USING (key) WHERE doc_id IS DISTINCT FROM first), n AS (SELECT r, count(*) AS n_dropped FROM g GROUP BY r), "
    "t AS (SELECT r, string_agg(line, chr(10) ORDER BY j) AS kept FROM x ANTI JOIN g USING (r, j) GROUP BY r) "
    "SELECT doc_id, len(l)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)"
)
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def _crc32_sql(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text, bit by bit in plain SQL."""
    byte = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT)"
    shifted = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, (s & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte}), lambda c, b: {shifted}), 4294967295::BIGINT)"


TYPO_EVERY = 97

_NEAR_SQL = (
    "x AS (SELECT word, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)), "
    "p AS (SELECT a.word AS a, b.word AS b FROM x a JOIN x b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word), "
    "q AS (SELECT x.word AS a, v.word AS b FROM x JOIN v ON x.rest = v.word), "
    "e AS (SELECT a, b FROM p UNION SELECT a, b FROM q UNION SELECT b, a FROM q), "
    "b AS (SELECT a AS word, count(*) AS n_near, arg_min(b, (-n, b)) AS form, max(n) AS form_n FROM e JOIN v ON v.word = e.b GROUP BY a), "
    "f AS (SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n FROM v LEFT JOIN b USING (word)), "
    "c AS (SELECT word, word AS here, form AS next FROM f UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON f.word = c.next) "
    "SELECT f.word, form, c.here AS root, n, n_near, form_n FROM f JOIN c ON c.word = f.word AND c.next IS NULL"
)


@catalog.query(
    "WITH RECURSIVE r AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times FROM "
    "(SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL), "
    f"h AS (SELECT run, times, {_crc32_sql('(doc_id::VARCHAR || chr(58) || run)')} AS h FROM r), "
    f"w AS (SELECT times, CASE WHEN h % {TYPO_EVERY} = 0 THEN run[:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word FROM h), "
    f"v AS (SELECT word, sum(times)::BIGINT AS n FROM w WHERE length(word) >= {variants.LEAST_CHARS} GROUP BY word HAVING sum(times) >= {variants.LEAST_COUNT}), " + _NEAR_SQL
)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of rows without an id are left as they are."""
    found = variants.runs(table(spark, sf_dir, "documents"))
    run, h = F.col("run"), F.col("h")
    keyed = found.select("run", F.crc32(F.concat(F.col("id").cast("string"), F.lit(":"), run)).alias("h"))
    word = F.when(h % TYPO_EVERY == 0, variants.without(run, (h % F.char_length(run)).cast("int"))).otherwise(run)
    return variants.variants(variants.vocabulary(keyed.select(word.alias("word"))))


MANIFEST_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _leaf_sql(n_chars: str) -> str:
    parts = [n_chars if c == "n_chars" else c for c in MANIFEST_COLUMNS]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({p}::VARCHAR))::VARCHAR || ':' || {p}::VARCHAR, '-')" for p in parts) + ")"


def _tree_sql(name: str, base: str) -> str:
    """Every level of every tree as a list of digests: (tree, lvl, l)."""
    return (
        f"{name} AS ({base} UNION ALL SELECT tree, lvl + 1, list_transform(range(0, len(l), 2), lambda i: sha256(l[i + 1] || coalesce(l[i + 2], ''))) FROM {name} WHERE len(l) > 1)"
    )


@catalog.query(
    f"WITH RECURSIVE d AS (SELECT *, {_leaf_sql('n_chars')} AS leaf, coalesce('=' || lang, '') AS tree FROM documents), "
    f"s AS (SELECT doc_id, leaf, tree, CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 7 = 0 THEN {_leaf_sql('(n_chars + 1)')} ELSE leaf END AS seen, "
    "row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k FROM d), "
    + _tree_sql("t", "SELECT tree, 0 AS lvl, list(leaf ORDER BY k) AS l FROM s GROUP BY tree")
    + ", u AS (SELECT tree, lvl AS height, l[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM t WHERE len(l) = 1), "
    + _tree_sql("o", "SELECT '' AS tree, 0 AS lvl, list(subroot ORDER BY place) AS l FROM u")
    + ", z AS (SELECT lvl AS top, l[1] AS root FROM o WHERE len(l) = 1), "
    "a AS (SELECT row_number() OVER () AS r, doc_id, leaf, seen, k, tree, height, subroot, place, top, root FROM s JOIN u USING (tree), z), "
    "m AS (SELECT r, lvl, (k >> lvl)::BIGINT AS i, l FROM a JOIN t USING (tree) WHERE lvl < height UNION ALL SELECT r, height + lvl, (place >> lvl)::BIGINT, l FROM a, o WHERE lvl < top), "
    "b AS (SELECT r, lvl, CASE WHEN i % 2 = 1 THEN l[i] ELSE '' END AS before, CASE WHEN i % 2 = 0 THEN coalesce(l[i + 2], '') ELSE '' END AS after FROM m), "
    "f AS (SELECT r, 0 AS lvl, seen AS node FROM a UNION ALL SELECT r, f.lvl + 1, sha256(before || node || after) FROM f JOIN b USING (r, lvl)), "
    "p AS (SELECT r, string_agg(before || after, '' ORDER BY lvl) AS proof FROM b GROUP BY r) "
    "SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, node AS folded_root, node = root AS verified FROM a JOIN f ON f.r = a.r AND f.lvl = height + top LEFT JOIN p ON p.r = a.r"
)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(remainder(F.col("doc_id"), 7) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return manifest.manifest(table(spark, sf_dir, "documents"), MANIFEST_COLUMNS, seen={"n_chars": tampered})


QUERIES = catalog.queries
ORACLE = catalog.oracle

"""SQL twins (DuckDB dialect) of the numbered queries that SQL can express."""

from __future__ import annotations

_WORDS = (
    "list_filter(string_split_regex({text}, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')"
)
_FOLD = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _embedding_links() -> str:
    """All pairs of unit vectors in double precision, and reachability by recursion."""
    return """
        WITH RECURSIVE v AS (
          SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        ok AS (
          SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
          WHERE e IS NOT NULL AND len(e) > 0
            AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        link AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id
          WHERE a.norm > 0 AND b.norm > 0 AND len(a.e) = len(b.e)
            AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
        reach(a, b) AS (
          SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
        low AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
        n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
        SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links,
          least(v.vec_id, coalesce(m, v.vec_id)) AS component_id,
          v.vec_id = least(v.vec_id, coalesce(m, v.vec_id)) AS kept
        FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN low ON low.a = v.vec_id"""


def _document_links() -> str:
    """Shingle sets joined on their shingles, exact similarity, and reachability by recursion."""
    words = _WORDS.format(text=_FOLD.format(text="text"))
    return f"""
        WITH RECURSIVE w AS (SELECT doc_id, coalesce({words}, []) AS w FROM documents),
        s AS (
          SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
            WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
            END) AS s FROM w),
        e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
        link AS (
          SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n
          HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reach(a, b) AS (
          SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
        low AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
        SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
          least(s.doc_id, coalesce(m, s.doc_id)) AS component_id,
          s.doc_id = least(s.doc_id, coalesce(m, s.doc_id)) AS kept
        FROM s LEFT JOIN low ON low.a = s.doc_id"""


def _repeats() -> str:
    """Every window of 20 words as text, and the first place of each."""
    words = _WORDS.format(text="text")
    return f"""
        WITH w AS (SELECT doc_id, coalesce({words}, []) AS w FROM documents),
        p AS (
          SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM w)),
        gone AS (
          SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM (
            SELECT doc_id, p, min((doc_id, p)) OVER (PARTITION BY g) AS first FROM p)
          WHERE (doc_id, p) > first),
        out AS (SELECT doc_id, list(p) AS p FROM gone GROUP BY doc_id),
        kept AS (
          SELECT w.doc_id, len(w) AS n, CASE WHEN out.p IS NULL THEN w ELSE
            list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(out.p, i)),
              lambda i: w[i]) END AS k
          FROM w LEFT JOIN out USING (doc_id))
        SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(k) AS BIGINT) AS n_removed,
          sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept"""


# CRC-32 of UTF-8 bytes: the table of the 256 byte steps, and a text's bytes taken through it.
_CRC_TABLE = """(SELECT list(list_reduce(range(8), lambda x, i: CASE WHEN x % 2 = 1
          THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, b) ORDER BY b) AS t FROM range(256) r(b))"""
_CRC = """xor(list_reduce(list_transform(range(0, octet_length(encode({text}))),
            lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS INT), 2) AS BIGINT)),
          lambda x, b: xor(x >> 8, t[CAST(xor(x, b) & 255 AS INT) + 1]), 4294967295), 4294967295)"""


def _resampled() -> str:
    """Buckets of the distinct words, gains, weights, and a window over all scores."""
    words = f"""regexp_extract_all({_FOLD.format(text="coalesce(text, '')")},
          '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""
    return f"""
        WITH crc AS {_CRC_TABLE},
        d AS (SELECT doc_id, {words} AS w FROM documents),
        dw AS (SELECT doc_id, unnest(w) AS w FROM d),
        bw AS (SELECT unnest(w) AS w FROM (SELECT {words} AS w FROM benchmark)),
        v AS (SELECT w, {_CRC.format(text="w")} % 10000 AS b
              FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc),
        s AS (SELECT b, count(*) AS n FROM dw JOIN v USING (w) GROUP BY b),
        t AS (SELECT b, count(*) AS n FROM bw JOIN v USING (w) GROUP BY b),
        gain AS (
          SELECT b, floor(1000 * ln(
            CAST((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM dw) + 10000) AS DOUBLE)
            / CAST((coalesce(s.n, 0) + 1) * ((SELECT count(*) FROM bw) + 10000) AS DOUBLE))) AS g
          FROM (SELECT DISTINCT b FROM v) LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
        weight AS (SELECT doc_id, sum(g) AS g FROM dw JOIN v USING (w) JOIN gain USING (b) GROUP BY doc_id),
        scored AS (
          SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features,
            CAST(coalesce(g, 0) AS BIGINT) AS weight,
            CAST(coalesce(g, 0) + floor(-1000 * ln(-ln(
              (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296)))
              AS BIGINT) AS score
          FROM d LEFT JOIN weight USING (doc_id)),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r
          FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <=
          (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20) THEN r END AS rank
        FROM placed"""


def _spellings() -> str:
    """Words with the planted slips, near words by their texts with one letter left out, and
    forms followed by recursion."""
    return f"""
        WITH RECURSIVE crc AS {_CRC_TABLE},
        run AS (
          SELECT doc_id, r, count(*) AS n FROM (
            SELECT doc_id, unnest(regexp_extract_all({_FOLD.format(text="coalesce(text, '')")},
              '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS r FROM documents)
          GROUP BY doc_id, r),
        h AS (SELECT r, n, {_CRC.format(text="(doc_id || ':' || r)")} AS h FROM run, crc),
        slip AS (
          SELECT n, CASE WHEN h % 199 = 0
            THEN substr(r, 1, CAST(h % length(r) AS INT)) || substr(r, CAST(h % length(r) AS INT) + 2)
            ELSE r END AS word FROM h),
        v AS (
          SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slip WHERE length(word) >= 6
          GROUP BY word HAVING sum(n) >= 5),
        cut AS (
          SELECT word, n, i, substr(word, 1, CAST(i - 1 AS INT)) || substr(word, CAST(i + 1 AS INT)) AS c
          FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
        pair AS (
          SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.c = b.c AND a.i = b.i
          WHERE a.word <> b.word
          UNION SELECT cut.word, v.word FROM cut JOIN v ON cut.c = v.word
          UNION SELECT v.word, cut.word FROM cut JOIN v ON cut.c = v.word),
        best AS (
          SELECT a, count(*) AS n_near, arg_min(struct_pack(b := v.word, n := v.n), (-v.n, encode(v.word))) AS top
          FROM pair JOIN v ON v.word = b GROUP BY a),
        form AS (
          SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
            CASE WHEN top.n >= 5 * v.n THEN top.b END AS form,
            CASE WHEN top.n >= 5 * v.n THEN top.n END AS form_n
          FROM v LEFT JOIN best ON best.a = v.word),
        walk(word, last, step) AS (
          SELECT word, word, 0 FROM form
          UNION ALL SELECT walk.word, form.form, step + 1
          FROM walk JOIN form ON form.word = walk.last WHERE form.form IS NOT NULL)
        SELECT word, form, (SELECT arg_max(last, step) FROM walk w WHERE w.word = form.word) AS root,
          n, CAST(n_near AS BIGINT) AS n_near, form_n
        FROM form"""


def oracle_sql() -> dict[str, str]:
    return {
        "op11_importance_resample": _resampled(),
        "op13_spelling_groups": _spellings(),
        "op1_embedding_neardup": _embedding_links(),
        "op5_minhash_neardup": _document_links(),
        "op7_substring_dedup": _repeats(),
    }

"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark code: plain SQL over the driver's tables,
with windows for order-dependent steps and recursive CTEs for the greedy scans.
Only the fixed values (patterns, genre list, separators, view recipe) are
shared, so a divergence in the Spark operators shows up as a mismatch.

DuckDB uses RE2 (no look-around): sentence boundaries are marked with
``chr(1)`` and split on it; ``documents`` never contains that character (a
test checks it).
"""

from __future__ import annotations

from ..functions import constants as K
from . import bookview as V
from . import queries as Q


def lit(s: str) -> str:
    """DuckDB expression for a Python string (control chars via ``chr``)."""
    out, buf = [], []
    for ch in s:
        if ord(ch) < 32 or ord(ch) == 160:
            if buf:
                out.append("'" + "".join(buf).replace("'", "''") + "'")
                buf = []
            out.append(f"chr({ord(ch)})")
        else:
            buf.append(ch)
    if buf or not out:
        out.append("'" + "".join(buf).replace("'", "''") + "'")
    return "(" + " || ".join(out) + ")"


NL2 = lit("\n\n")
PAT = lit(K.HEADING_PATTERN)
GENRES = "[" + ", ".join(lit(g) for g in K.GENRES_KEPT) + "]"
LANGS = ", ".join(lit(x) for x in Q.LANGUAGES)
# the rule in its own words: end signs, any closers, white space, at most one opener, upper case
SENT_RE = lit("([.!?][\"”’')\\]]*)\\s+([\"“‘'(\\[]?\\p{Lu})")
SENT_REPL = "('\\1' || chr(1) || '\\2')"
WORDS = "len(regexp_extract_all({x}, '\\S+'))"
T_AGG = Q.THRESHOLD
M_CHUNK = Q.MAX_LEN


def _shelf_case() -> str:
    whens = " ".join(f"WHEN {i} THEN {'NULL' if s is None else lit(s)}"
                     for i, s in enumerate(V.SHELVES))
    return f"CASE (text_id // 10) % {len(V.SHELVES)} {whens} END"


def _norm(x: str) -> str:
    e = x
    for old, new in K.NORMALISE_REPLACEMENTS:
        if old != new:
            e = f"replace({e}, {lit(old)}, {lit(new)})"
    return f"regexp_replace({e}, '\\s+', ' ', 'g')"


def _words_spaced(p: str) -> str:
    return f"CAST(CASE WHEN {p} = '' THEN 0 ELSE length({p}) - length(replace({p}, ' ', '')) + 1 END AS BIGINT)"


def _pack(name: str, src: str) -> str:
    """Recursive sentence packing over ``src(key, j, s, k, lim)``."""
    return f"""{name}(key, j, g, acc) AS (
  SELECT key, j, 0, k FROM {src} WHERE j = 1
  UNION ALL
  SELECT s.key, s.j, p.g + CASE WHEN p.acc + s.k > s.lim THEN 1 ELSE 0 END,
         CASE WHEN p.acc + s.k > s.lim THEN s.k ELSE p.acc + s.k END
  FROM {name} p JOIN {src} s ON s.key = p.key AND s.j = p.j + 1)"""


def _sentence_rows(name: str, src: str, key: str, text: str, lim: str) -> str:
    """``name(key, j, s, k, lim)``: sentences of ``text`` in ``src``."""
    return f"""{name}_a AS (
  SELECT {key} AS key, {lim} AS lim,
         string_split(regexp_replace(trim({text}), {SENT_RE}, {SENT_REPL}, 'g'), chr(1)) AS arr
  FROM {src}),
{name}_u AS (SELECT key, lim, unnest(arr) AS s, generate_subscripts(arr, 1) AS j FROM {name}_a),
{name} AS (SELECT key, j, s, {WORDS.format(x='s')} AS k, lim FROM {name}_u)"""


def _stage2(x: str, src: str) -> str:
    """Segments, greedy merge and pieces of the rows of ``src``; names end in ``x``."""
    return f"""sg{x} AS (
  SELECT *, lag(text_ids) OVER w AS pt_, lag(paragraphs_index) OVER w AS pidx_, lag(chapters) OVER w AS pc_,
         row_number() OVER w AS rr_
  FROM {src} WINDOW w AS (ORDER BY paragraphs_index)),
sf{x} AS (
  SELECT *, (rr_ = 1 OR (pt_ IS NOT NULL AND pt_ IS DISTINCT FROM text_ids)
             OR (pidx_ IS NOT NULL AND paragraphs_index - 1 <> pidx_)
             OR chapters IS DISTINCT FROM pc_) AS new_segment
  FROM sg{x}),
sn{x} AS (SELECT *, sum(CASE WHEN new_segment THEN 1 ELSE 0 END) OVER (
                   ORDER BY paragraphs_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM sf{x}),
nr{x} AS (SELECT *, row_number() OVER (PARTITION BY seg ORDER BY paragraphs_index) AS r FROM sn{x}),
f{x}(seg, r, g, acc, closed) AS (
  SELECT seg, r, 0, CASE WHEN n_words >= {T_AGG} THEN 0 ELSE n_words END, n_words >= {T_AGG} FROM nr{x} WHERE r = 1
  UNION ALL
  SELECT nr{x}.seg, nr{x}.r, f{x}.g + CASE WHEN f{x}.closed THEN 1 ELSE 0 END,
         CASE WHEN f{x}.acc + nr{x}.n_words >= {T_AGG} THEN 0 ELSE f{x}.acc + nr{x}.n_words END,
         f{x}.acc + nr{x}.n_words >= {T_AGG}
  FROM f{x} JOIN nr{x} ON nr{x}.seg = f{x}.seg AND nr{x}.r = f{x}.r + 1),
agg{x} AS (
  SELECT string_agg(q.paragraphs, {NL2} ORDER BY q.r) AS paragraphs, min(q.chapters) AS chapters,
         CAST(sum(q.n_words) AS BIGINT) AS n_words, min(q.text_ids) AS text_ids,
         arg_min(q.span_start, q.r) AS span_start, arg_max(q.span_end, q.r) AS span_end,
         min(q.paragraphs_index) AS agg_order
  FROM nr{x} q JOIN f{x} USING (seg, r) GROUP BY q.seg, f{x}.g),
ca{x} AS (SELECT *, {WORDS.format(x='paragraphs')} AS nw FROM agg{x}),
{_sentence_rows(f'cs{x}', f'ca{x} WHERE nw >= {M_CHUNK}', 'agg_order', 'paragraphs',
                f'CAST(floor({M_CHUNK} / ceil(nw / {M_CHUNK})) AS BIGINT)')},
{_pack(f'cp{x}', f'cs{x}')},
pieces{x} AS (
  SELECT z.key, c.g, string_agg(z.s, ' ' ORDER BY z.j) AS text
  FROM cs{x} z JOIN cp{x} c USING (key, j) GROUP BY z.key, c.g),
chunks{x} AS (
  SELECT paragraphs, CAST(nw AS BIGINT) AS n_words, text_ids, chapters, span_start, span_end,
         false AS splitted_paragraphs, agg_order, CAST(0 AS BIGINT) AS piece
  FROM ca{x} WHERE nw < {M_CHUNK}
  UNION ALL
  SELECT y.text AS paragraphs, CAST({WORDS.format(x='y.text')} AS BIGINT) AS n_words,
         q.text_ids, q.chapters, q.span_start, q.span_end, true AS splitted_paragraphs,
         q.agg_order, CAST(y.g AS BIGINT) AS piece
  FROM pieces{x} y JOIN ca{x} q ON q.agg_order = y.key)"""


def _embedded(src: str, keys: str) -> str:
    """Hashed unit vectors of ``src`` (keys, paragraphs): slots by md5's first 32 bits."""
    return f"""SELECT {keys}, dim, CAST(n / greatest(sqrt(sum(n * n) OVER (PARTITION BY {keys})), 1e-12) AS FLOAT) AS value
               FROM (SELECT {keys}, CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % {Q.EMBED_DIM} AS dim,
                            CAST(count(*) AS DOUBLE) AS n
                     FROM (SELECT {keys}, unnest(regexp_extract_all(lower(paragraphs), '[\\p{{L}}\\p{{N}}]+')) AS token
                           FROM {src})
                     GROUP BY ALL)"""


BASE = f"""
d AS (
  SELECT doc_id, text,
         CAST((doc_id // {V.BOOK_BLOCK}) * 10
              + CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS BIGINT) AS text_id
  FROM documents),
dp AS (SELECT text_id, doc_id, text, row_number() OVER (PARTITION BY text_id ORDER BY doc_id) AS rn FROM d),
parts AS (
  SELECT text_id, doc_id,
         CASE WHEN rn % 4 = 1 THEN 'CHAPTER ' || substr({lit(V.ROMAN)}, CAST((rn // 4) % 5 + 1 AS INTEGER), 1) || {NL2}
              ELSE '' END
         || replace(text, chr(10), {NL2})
         || CASE WHEN doc_id % 7 = 0 THEN {NL2} || {lit(V.FOOTNOTE)} ELSE '' END
         || CASE WHEN doc_id % 11 = 0 THEN {NL2} || {lit(V.ILLUSTRATION)} ELSE '' END
         || CASE WHEN doc_id % 5 = 0 THEN {NL2} || {lit(V.DIALOGUE)} ELSE '' END
         || CASE WHEN doc_id % 3 = 0 THEN {NL2} || {lit(V.CRLF_LINE)} ELSE '' END
         || CASE WHEN doc_id % 17 = 0 THEN {NL2} || {lit(V.SCENE_BREAK)} ELSE '' END AS part
  FROM dp),
books AS (SELECT text_id, string_agg(part, {NL2} ORDER BY doc_id) AS book FROM parts GROUP BY text_id),
corpus AS (
  SELECT CAST(text_id AS VARCHAR) AS id, book AS text, 'documents' AS source, '2024-01-01' AS added,
         CASE text_id % 10 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'de' ELSE 'es' END AS language,
         'books/' || CAST(text_id AS VARCHAR) AS url, text_id AS corpus_order
  FROM books),
catalog AS (
  SELECT corpus_order AS "Text#", language AS "Language", {_shelf_case().replace('text_id', 'corpus_order')} AS "Bookshelves"
  FROM corpus),
meta AS (SELECT CAST(NULL AS VARCHAR) AS license, language, url, CAST(NULL AS VARCHAR) AS title,
                TRY_CAST(trim(id) AS BIGINT) AS text_id FROM corpus),
merged AS (
  SELECT c."Language" AS "Language", m.text_id AS text_id, c."Bookshelves" AS "Bookshelves"
  FROM catalog c JOIN meta m ON c."Text#" = m.text_id),
shelves AS (
  SELECT "Text#" AS text_id, "Bookshelves",
         string_split_regex(replace(replace(lower(replace("Bookshelves", {lit(K.SHELF_PREFIX)}, '')), '-', ''), ' ', ''),
                            {lit(K.SHELF_SEPARATORS)}) AS sh
  FROM catalog WHERE "Bookshelves" IS NOT NULL),
genre AS (
  SELECT text_id, "Bookshelves", sh, len(list_filter(sh, lambda x: NOT list_contains({GENRES}, x))) = 0 AS keep
  FROM shelves),
kept AS (
  SELECT m.* FROM merged m
  WHERE m."Language" IN ({LANGS}) AND m."Bookshelves" IS NOT NULL
    AND len(list_filter(string_split_regex(replace(replace(lower(replace(m."Bookshelves", {lit(K.SHELF_PREFIX)}, '')), '-', ''), ' ', ''),
                                           {lit(K.SHELF_SEPARATORS)}),
                        lambda x: NOT list_contains({GENRES}, x))) = 0),
nb AS (SELECT TRY_CAST(trim(id) AS BIGINT) AS text_ids, corpus_order, {_norm('text')} AS norm FROM corpus),
sp AS (SELECT text_ids, corpus_order, norm, NOT regexp_matches(norm, {PAT}) AS nochap,
              string_split(norm, {lit(K.PARAGRAPH_MARKER)}) AS arr FROM nb),
pt AS (SELECT text_ids, corpus_order, nochap, unnest(arr) AS raw, generate_subscripts(arr, 1) - 1 AS pos FROM sp),
hd AS (SELECT text_ids, corpus_order, nochap, CAST(pos AS BIGINT) AS pos, trim(raw) AS p,
              regexp_extract(trim(raw), {PAT}, 0) AS h,
              coalesce(sum(length(raw) + {len(K.PARAGRAPH_MARKER)}) OVER (
                PARTITION BY corpus_order ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              + length(raw) - length(ltrim(raw)) AS true_start
       FROM pt),
ch AS (SELECT *, last_value(NULLIF(h, '') IGNORE NULLS) OVER (
                   PARTITION BY corpus_order ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS chapter,
              {_words_spaced('p')} AS nw
       FROM hd),
fl AS (
  SELECT *, nw > {K.MIN_WORDS} AS more_three_words,
         (nw > {K.DIALOGUE_MAX_WORDS} OR ({' AND '.join(f'strpos(p, {lit(q)}) = 0' for q in K.DIALOGUE_QUOTES)})) AS not_dialog,
         NOT (regexp_matches(p, '\\p{{Lu}}') AND NOT regexp_matches(p, '[\\p{{Ll}}\\p{{Lt}}]')) AS not_all_upper,
         NOT regexp_matches(lower(p), {lit(K.FOOTNOTE_PATTERN)}) AS not_footnote,
         NOT regexp_matches(lower(p), {lit(K.TRANSCRIBER_PATTERN)}) AS not_transcriber,
         NOT regexp_matches(lower(p), {lit(K.ILLUSTRATION_PATTERN)}) AS not_illustration
  FROM ch),
kp AS (
  SELECT fl.*, strpos(nb.norm, fl.p) - 1 AS span_start
  FROM fl JOIN nb USING (corpus_order)
  WHERE h = '' AND (chapter IS NOT NULL OR nochap) AND more_three_words AND not_dialog AND not_all_upper
    AND not_footnote AND not_transcriber AND not_illustration),
pi AS (
  SELECT p AS paragraphs, text_ids, CAST(span_start AS BIGINT) AS span_start,
         CAST(span_start + length(p) AS BIGINT) AS span_end, chapter AS chapters,
         CAST(row_number() OVER (ORDER BY corpus_order, pos) - 1 AS BIGINT) AS paragraphs_index,
         nw AS n_words
  FROM kp),
pj AS (
  SELECT p AS paragraphs, text_ids, CAST(span_start AS BIGINT) AS span_start,
         CAST(span_start + length(p) AS BIGINT) AS span_end, chapter AS chapters,
         CAST(row_number() OVER (ORDER BY corpus_order, pos) - 1 AS BIGINT) AS paragraphs_index,
         nw AS n_words
  FROM kp WHERE text_ids IN (SELECT text_id FROM kept)),
{_stage2('', 'pi')},
two AS (
  SELECT * REPLACE (CAST(row_number() OVER (ORDER BY text_ids % 10 <> 0, paragraphs_index) - 1 AS BIGINT) AS paragraphs_index)
  FROM pi),
{_stage2('2', 'two')},
head AS (SELECT * FROM pi WHERE paragraphs_index < {Q.HEAD}),
{_stage2('3', 'head')},
tk AS (
  SELECT lower(regexp_replace(t, '[.''’-]*$', '')) AS word, ends_with(t, '.') AS period
  FROM (SELECT unnest(regexp_extract_all(paragraphs, '[\\p{{L}}\\p{{N}}][\\p{{L}}\\p{{N}}.''’-]*')) AS t FROM pi)
  WHERE regexp_matches(t, '\\p{{L}}')),
tc AS (
  SELECT word, count(*) AS n, count(*) FILTER (period) AS k, CAST(length(replace(word, '.', '')) AS DOUBLE) AS size,
         length(word) - length(replace(word, '.', '')) AS inside
  FROM tk GROUP BY word),
ts AS (SELECT sum(k) / sum(n) AS share FROM tc),
ab AS (
  SELECT word, n, k, CASE WHEN share > 0 AND share < 1 THEN
           2 * ((k * ln(0.99) + (n - k) * ln(1 - 0.99)) - (k * ln(share) + (n - k) * ln(1 - share)))
           / exp(size) / exp((n - k) * ln(size)) * (1 + inside) END AS score
  FROM tc, ts WHERE k > 0),
al AS (
  SELECT coalesce(string_agg(replace(word, '.', '\\.'), '|' ORDER BY length(word) DESC, word), chr(3)) AS listed FROM (
    SELECT word FROM ab WHERE score >= {Q.LEARNED} AND length(word) <= 12 ORDER BY score DESC, word LIMIT 500)),
{_sentence_rows('ps', 'pi WHERE n_words > 0', 'paragraphs_index', 'paragraphs',
                f'CAST(floor({Q.SPLIT_MAX} / ceil(n_words / {Q.SPLIT_MAX})) AS BIGINT)')},
{_pack('pp', 'ps')},
cv AS (
  SELECT text AS paragraphs, conv_id AS text_ids, turn AS paragraphs_index, CAST(turn AS BIGINT) AS span_start,
         CAST(turn + 1 AS BIGINT) AS span_end, CAST(NULL AS VARCHAR) AS chapters,
         CAST({WORDS.format(x='text')} AS BIGINT) AS n_words, conv_id, turn
  FROM conversations),
cvl AS (
  SELECT *, lag(text_ids) OVER w AS pt_, lag(paragraphs_index) OVER w AS pidx_, lag(chapters) OVER w AS pc_,
         row_number() OVER w AS rr_
  FROM cv WINDOW w AS (ORDER BY conv_id, turn)),
cvs AS (
  SELECT *, sum(CASE WHEN rr_ = 1 OR (pt_ IS NOT NULL AND pt_ IS DISTINCT FROM text_ids)
                          OR (pidx_ IS NOT NULL AND paragraphs_index - 1 <> pidx_)
                          OR chapters IS DISTINCT FROM pc_ THEN 1 ELSE 0 END)
              OVER (ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg
  FROM cvl),
cvr AS (SELECT *, row_number() OVER (PARTITION BY seg ORDER BY conv_id, turn) AS r FROM cvs),
cvf(seg, r, g, acc, closed) AS (
  SELECT seg, r, 0, CASE WHEN n_words >= {Q.CONV_THRESHOLD} THEN 0 ELSE n_words END, n_words >= {Q.CONV_THRESHOLD}
  FROM cvr WHERE r = 1
  UNION ALL
  SELECT cvr.seg, cvr.r, cvf.g + CASE WHEN cvf.closed THEN 1 ELSE 0 END,
         CASE WHEN cvf.acc + cvr.n_words >= {Q.CONV_THRESHOLD} THEN 0 ELSE cvf.acc + cvr.n_words END,
         cvf.acc + cvr.n_words >= {Q.CONV_THRESHOLD}
  FROM cvf JOIN cvr ON cvr.seg = cvf.seg AND cvr.r = cvf.r + 1)
"""


def _q(select: str) -> str:
    return "WITH RECURSIVE " + BASE.strip() + "\n" + select


ORACLE = {
    "scan_corpus": _q("SELECT id, text, source, added, language, url, CAST(length(text) AS BIGINT) AS n_chars FROM corpus"),
    "extract_metadata": _q("SELECT * FROM meta"),
    "merge_catalog": _q('SELECT "Language", text_id, "Bookshelves" FROM merged'),
    "read_catalog": _q("""SELECT "Text#" AS text_id, 'Text' AS "Type", '2024-01-01' AS "Issued", 'Book ' || "Text#" AS "Title",
                          "Language", 'Anonymous' AS "Authors", 'Fiction' AS "Subjects", 'PZ' AS "LoCC", "Bookshelves"
                          FROM catalog"""),
    "metadata_csv": _q("SELECT *, CAST(row_number() OVER (ORDER BY text_id) - 1 AS BIGINT) AS idx FROM meta"),
    "bookshelves": _q('SELECT text_id, "Bookshelves", array_to_string(sh, \'|\') AS shelves, '
                      'CAST(len(sh) AS BIGINT) AS n_shelves FROM shelves'),
    "genre_exclusive": _q('SELECT text_id, "Bookshelves", keep FROM genre'),
    "kept_books": _q('SELECT "Language", text_id, "Bookshelves" FROM kept'),
    "filter_corpus": _q("SELECT id, text FROM corpus WHERE TRY_CAST(trim(id) AS BIGINT) IN (SELECT text_id FROM kept)"),
    "filter_corpus_screened": _q("SELECT id, text FROM corpus WHERE id IN (SELECT CAST(text_id AS VARCHAR) FROM kept)"),
    "catalog_faults": _q("""SELECT CASE WHEN "Language" <> 'fr' THEN "Text#" END AS text_id, 'Book ' || "Text#" AS "Title",
                            "Language", "Bookshelves", CASE "Language" WHEN 'de' THEN 'long' WHEN 'fr' THEN 'id' END AS malformed
                            FROM catalog"""),
    "normalize_text": _q("SELECT corpus_order AS text_id, norm FROM nb"),
    "split_book": _q("SELECT text_ids, pos, p AS paragraph FROM hd"),
    "headings": _q("SELECT text_ids, pos, h AS heading FROM hd WHERE h <> ''"),
    "chapterization_flag": _q("SELECT text_ids, nochap AS no_chapterization FROM sp"),
    "chapter_fill": _q("SELECT text_ids, pos, chapter FROM ch"),
    "inclusion_flags": _q("SELECT text_ids, pos, nw AS n_words, more_three_words, not_dialog, not_all_upper, "
                          "not_footnote, not_transcriber, not_illustration FROM fl WHERE h = ''"),
    "included_paragraphs": _q("SELECT text_ids, pos, p AS paragraph FROM fl WHERE h = '' AND more_three_words "
                              "AND not_dialog AND not_all_upper AND not_footnote AND not_transcriber "
                              "AND not_illustration"),
    "spans": _q("SELECT text_ids, pos, CAST(span_start AS BIGINT) AS span_start, "
                "CAST(span_start + length(p) AS BIGINT) AS span_end FROM kp"),
    "spans_true": _q("SELECT text_ids, pos, CAST(true_start AS BIGINT) AS span_start, "
                     "CAST(true_start + length(p) AS BIGINT) AS span_end FROM kp"),
    "paragraphs": _q("SELECT * FROM pj"),
    "paragraphs_indexed": _q("SELECT * FROM pi"),
    "slice_paragraphs": _q(f"SELECT * FROM pi WHERE paragraphs_index >= {Q.SLICE[0]} "
                           f"AND paragraphs_index < {Q.SLICE[1]}"),
    "segments": _q("SELECT paragraphs_index, text_ids, chapters, new_segment FROM sf"),
    "aggregates": _q("SELECT paragraphs, chapters, n_words, text_ids, span_start, span_end, agg_order FROM agg"),
    "conversation_aggregates": _q(f"""SELECT string_agg(cvr.paragraphs, {NL2} ORDER BY cvr.r) AS paragraphs,
                                             min(cvr.chapters) AS chapters, CAST(sum(cvr.n_words) AS BIGINT) AS n_words,
                                             min(cvr.text_ids) AS text_ids, arg_min(cvr.span_start, cvr.r) AS span_start,
                                             arg_max(cvr.span_end, cvr.r) AS span_end, arg_min(cvr.turn, cvr.r) AS turn
                                      FROM cvr JOIN cvf USING (seg, r) GROUP BY cvr.seg, cvf.g"""),
    "sentences": _q("""SELECT paragraphs_index, CAST(pos AS BIGINT) AS pos, sentence,
                       CAST(len(regexp_extract_all(sentence, '\\S+')) AS BIGINT) AS n_words FROM (
                         SELECT paragraphs_index, unnest(arr) AS sentence, generate_subscripts(arr, 1) - 1 AS pos FROM (
                           SELECT paragraphs_index,
                                  string_split(regexp_replace(trim(paragraphs), """ + SENT_RE + ", " + SENT_REPL +
                    """, 'g'), chr(1)) AS arr FROM pi))"""),
    "abbreviation_scores": _q("SELECT word, n, k AS n_period, round(score, 6) + CAST(0 AS DOUBLE) AS score FROM ab"),
    # periods of abbreviations stand aside as chr(2) while the text is cut
    "sentences_learned": _q("""SELECT paragraphs_index, CAST(pos AS BIGINT) AS pos, replace(s, chr(2), '.') AS sentence FROM (
                         SELECT paragraphs_index, unnest(arr) AS s, generate_subscripts(arr, 1) - 1 AS pos FROM (
                           SELECT paragraphs_index, string_split(regexp_replace(regexp_replace(trim(paragraphs),
                                    '(?i)(^|[^\\p{L}\\p{N}.])(' || listed || ')\\.', '\\1\\2' || chr(2), 'g'), """ + SENT_RE + ", " +
                            SENT_REPL + """, 'g'), chr(1)) AS arr FROM pi, al))"""),
    "piece_limit_unrounded": _q(f"SELECT paragraphs_index, n_words, CAST({Q.PIECE_MAX} / ceil(n_words / {Q.PIECE_MAX}) AS DOUBLE) "
                                "AS piece_limit FROM pi WHERE n_words > 0"),
    "piece_limit": _q(f"SELECT paragraphs_index, n_words, CAST(floor({Q.PIECE_MAX} / ceil(n_words / {Q.PIECE_MAX})) "
                      f"AS BIGINT) AS piece_limit FROM pi WHERE n_words > 0"),
    "split_paragraphs": _q("""SELECT ps.key AS paragraphs_index, CAST(pp.g AS BIGINT) AS piece,
                                     string_agg(ps.s, ' ' ORDER BY ps.j) AS text,
                                     CAST(len(regexp_extract_all(string_agg(ps.s, ' ' ORDER BY ps.j), '\\S+')) AS BIGINT) AS n_words
                              FROM ps JOIN pp USING (key, j) GROUP BY ps.key, pp.g"""),
    "chunks": _q("SELECT * FROM chunks"),
    "chunks_head": _q("SELECT * FROM chunks3"),
    "slice_chunks": _q("SELECT * EXCLUDE (agg_order, piece, r) FROM (SELECT *, row_number() OVER (ORDER BY agg_order, piece) - 1 "
                       f"AS r FROM chunks) WHERE r >= {Q.CHUNK_SLICE[0]} AND r < {Q.CHUNK_SLICE[1]}"),
    "chunks_no_index": _q("SELECT * FROM chunks"),
    "chunks_two_tables": _q("SELECT * FROM chunks2"),
    "chunk_table": _q("SELECT * EXCLUDE (agg_order, piece), "
                      "CAST(row_number() OVER (ORDER BY agg_order, piece) - 1 AS BIGINT) AS chunk_row FROM chunks"),
    "embed_chunks": _q(_embedded("chunks", "agg_order, piece")),
    "embed_paragraphs": _q(_embedded("pi", "paragraphs_index")),
    "embed_encoder": _q(_embedded("pi", "paragraphs_index")),
    "embed_paragraph_slice": _q(_embedded(
        f"(SELECT * FROM pi WHERE paragraphs_index >= {Q.SLICE[0]} AND paragraphs_index < {Q.SLICE[1]})", "paragraphs_index")),
    "unit_embeddings": _q("""SELECT vec_id, label, CAST(i - 1 AS BIGINT) AS dim,
                                    CAST(CAST(x AS DOUBLE) / greatest(sqrt(ss), 1e-12) AS FLOAT) AS x FROM (
                               SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i,
                                      list_reduce(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)),
                                                  lambda a, b: a + b) AS ss
                               FROM embeddings)"""),
}

for _name in ("aggregates", "conversation_aggregates"):
    ORACLE[f"{_name}_tiny_buckets"] = ORACLE[_name]

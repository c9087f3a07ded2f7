"""The registered queries as DuckDB SQL over the flat tables."""

from __future__ import annotations

# One row per order, with the fields of its nested record.
_REC = """
rec AS (
  SELECT o_orderkey, o_orderstatus AS version, concat('2-s2.0-', o_orderkey) AS eid,
         CASE WHEN o_orderkey % 13 <> 0 THEN concat('10.5555/', o_orderkey) END AS doi,
         concat(o_orderpriority, ' ', o_orderkey) AS title, o_orderstatus AS pub_type,
         CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         CAST(o_orderkey % 50 AS INTEGER) AS citation_count, o_totalprice AS fwci,
         CASE WHEN r_name <> 'AFRICA' THEN r_name END AS publisher, c_mktsegment AS journal,
         CASE WHEN c_nationkey <> 24 THEN CAST(c_nationkey AS BIGINT) END AS source,
         CASE WHEN c_nationkey % 7 = 0 THEN NULL
              WHEN c_nationkey = 5 AND o_orderkey % 2 = 0 THEN CAST(1.233 AS DOUBLE)
              WHEN c_nationkey = 5 THEN CAST(1.234 AS DOUBLE)
              ELSE CAST(n_regionkey AS DOUBLE) + CAST(0.5 AS DOUBLE) END AS cite,
         c_nationkey, concat('["', o_orderpriority, '"]') AS expressions,
         CASE WHEN c_nationkey % 11 <> 0 THEN CAST(c_nationkey AS BIGINT) END AS topic_id,
         concat(c_mktsegment, '|', n_name) AS keywords, CAST(n_regionkey AS DOUBLE) AS prominence,
         r_name, CAST(n_regionkey AS BIGINT) AS cluster_id
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""

# One row per order line, with the fields of its child records.
_LINE = _REC + """,
line AS (
  SELECT rec.version, rec.eid, l_linenumber, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag,
         p_partkey, p_name, p_size, p_type, s_name, s_nationkey, n_name,
         CAST(l_suppkey % 30000 AS INTEGER) AS sequence,
         CASE WHEN l_suppkey % 10 <> 0 THEN l_suppkey END AS author_id,
         concat('G', l_linenumber) AS given_name,
         CASE WHEN l_linenumber = 1 THEN 'Al' ELSE 'Alexander' END AS pn_given_name,
         CASE WHEN p_size < 5 THEN lpad(CAST(p_size AS VARCHAR), 4, '0') ELSE CAST(1000 + p_size AS VARCHAR) END AS asjc,
         CASE WHEN l_linenumber = 7 THEN '' ELSE concat(s_nationkey, '|', l_suppkey) END AS affiliation_ids,
         CASE WHEN l_linenumber = 6 THEN concat(n_name, ', ', repeat('x', 800)) ELSE n_name END AS organization,
         concat('Dock|', s_nationkey) AS address, substr(n_name, 1, 2) AS country_code,
         CASE WHEN l_linenumber % 2 = 0 THEN 'ST' END AS state
    FROM rec
    JOIN lineitem ON l_orderkey = rec.o_orderkey
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey)"""

_JOURNAL = """,
journal AS (SELECT DISTINCT version, publisher, journal, source, cite FROM rec)"""

_PUB = _JOURNAL + """,
pub AS (
  SELECT r.version, r.eid, j.cite AS journal_cite, j.publisher AS journal_publisher, j.journal AS journal_title,
         r.title, r.doi, r.year, r.month, r.pub_type, r.citation_count, r.fwci, r.expressions
    FROM (SELECT DISTINCT version, eid, title, doi, year, month, pub_type, citation_count, fwci, expressions, journal,
                 source, publisher FROM rec) r
    JOIN journal j ON j.version = r.version AND j.journal = r.journal AND j.source = r.source
                  AND j.publisher IS NOT DISTINCT FROM r.publisher)"""

_MENTION = """,
mention AS (
  SELECT version, eid, p_name AS alias,
         CASE WHEN l_linenumber <> 7 AND k = 1 THEN l_returnflag END AS snippet,
         CASE WHEN p_size <= 40 THEN CAST(1000 + p_size AS BIGINT) END AS alias_id,
         CASE WHEN p_size <= 40 THEN l_discount END AS fuzzy_score,
         CASE WHEN p_size <= 40 THEN l_discount > CAST(0.05 AS DOUBLE) END AS is_fuzzy,
         model, CASE model WHEN 'model1' THEN l_discount WHEN 'model2' THEN l_tax ELSE CAST(0 AS DOUBLE) END AS score
    FROM line
    JOIN (VALUES (1), (2), (3)) s(k) ON l_linenumber <> 7 OR k = 1
    JOIN (VALUES ('model1'), ('model2'), ('modelX')) m(model) ON model <> 'modelX' OR l_quantity > 45)"""

_ALIAS = """,
alias AS (
  SELECT version, a.* FROM (SELECT DISTINCT o_orderstatus AS version FROM orders) v CROSS JOIN (
    SELECT DISTINCT CAST(1000 + p_size AS BIGINT) AS alias_id, concat('size-', p_size) AS alias,
           CAST(p_size % 5 + 1 AS BIGINT) AS parent_alias_id, 'alias' AS alias_type
      FROM part WHERE p_size <= 40 AND p_size % 9 <> 0
    UNION ALL
    SELECT i, concat('group-', i), i, 'parent' FROM (SELECT CAST(unnest(range(1, 6)) AS BIGINT) AS i)) a)"""

_DYAD = _PUB + _MENTION + _ALIAS + """,
dyad AS (
  SELECT DISTINCT p.version, p.eid, p.journal_cite, a.alias AS dataset, m.alias_id, m.fuzzy_score, m.is_fuzzy,
         m.alias AS mention_candidate, m.snippet
    FROM (SELECT DISTINCT version, eid, alias_id, fuzzy_score, is_fuzzy, alias, snippet FROM mention) m
    JOIN pub p ON p.version = m.version AND p.eid = m.eid
    LEFT JOIN alias a ON a.version = m.version AND a.alias_id = m.alias_id)"""

_DYAD_MODEL = _DYAD + """,
dyad_model AS (
  SELECT DISTINCT d.*, m.model, m.score
    FROM dyad d
    JOIN (SELECT DISTINCT version, eid, alias_id, alias, snippet, model, score FROM mention
           WHERE model IN ('string_matching', 'model1', 'model2', 'model3')) m
      ON m.version = d.version AND m.eid = d.eid AND m.alias_id IS NOT DISTINCT FROM d.alias_id
     AND m.alias = d.mention_candidate AND m.snippet IS NOT DISTINCT FROM d.snippet)"""

_AUTHOR = """,
author AS (
  SELECT version, author_id, pn_given_name, s_name FROM (
    SELECT *, row_number() OVER (PARTITION BY version, author_id
              ORDER BY length(rtrim(concat(pn_given_name, s_name))) DESC NULLS LAST, s_name, pn_given_name) AS rank
      FROM (SELECT DISTINCT version, author_id, pn_given_name, s_name FROM line))
   WHERE rank = 1)"""

_PUB_AUTHOR = """,
pub_author AS (
  SELECT DISTINCT p.version, p.eid, p.journal_cite, l.author_id, l.given_name, l.s_name, l.l_linenumber
    FROM line l JOIN pub p ON p.version = l.version AND p.eid = l.eid)"""

_PUB_AFFILIATION = """,
pub_affiliation AS (
  SELECT DISTINCT p.version, p.eid, p.journal_cite, l.sequence, l.affiliation_ids, l.organization, l.address,
         l.n_name AS city, l.state, l.country_code
    FROM line l JOIN pub p ON p.version = l.version AND p.eid = l.eid)"""

_AUTHOR_AFFILIATION = """,
author_affiliation AS (
  SELECT DISTINCT pa.version, pa.eid, pa.journal_cite, pa.author_id, pa.given_name, pa.s_name, pa.l_linenumber,
         af.sequence, af.affiliation_ids, af.organization, af.address, af.city, af.state, af.country_code
    FROM line l
    JOIN author a ON a.version = l.version AND a.author_id = l.author_id AND a.pn_given_name = l.pn_given_name
                 AND a.s_name = l.s_name
    JOIN pub p ON p.version = l.version AND p.eid = l.eid
    JOIN pub_author pa ON pa.version = p.version AND pa.eid = p.eid AND pa.journal_cite IS NOT DISTINCT FROM p.journal_cite
                      AND pa.author_id = a.author_id AND pa.given_name = l.given_name AND pa.s_name = l.s_name
    JOIN pub_affiliation af ON af.version = p.version AND af.eid = p.eid
                           AND af.journal_cite IS NOT DISTINCT FROM p.journal_cite AND af.sequence = l.sequence)"""

_PUB_ASJC = """,
pub_asjc AS (
  SELECT p.version, p.eid, p.journal_cite, a.code, a.label
    FROM line l
    JOIN pub p ON p.version = l.version AND p.eid = l.eid
    JOIN (SELECT DISTINCT version, CAST(asjc AS BIGINT) AS code, p_type AS label, asjc FROM line) a
      ON a.version = l.version AND CAST(a.code AS VARCHAR) = l.asjc)"""

_PUB_TOPIC = """,
topic AS (SELECT DISTINCT version, keywords, topic_id, prominence FROM rec WHERE topic_id IS NOT NULL),
pub_topic AS (
  SELECT DISTINCT p.version, p.eid, p.journal_cite, t.topic_id, t.keywords, t.prominence
    FROM pub p
    JOIN rec r ON r.version = p.version AND r.eid = p.eid
    JOIN topic t ON t.version = r.version AND t.topic_id = r.topic_id)"""

_PUB_UFC = """,
pub_ufc AS (
  SELECT DISTINCT p.version, p.eid, p.journal_cite, l.p_partkey, l.p_name, l.l_discount,
         CAST(l.l_quantity AS INTEGER) AS a_freq
    FROM line l JOIN pub p ON p.version = l.version AND p.eid = l.eid)"""

_ISSN = """,
issn AS (
  SELECT DISTINCT j.version, j.publisher, j.journal, j.source, j.cite, i.issn
    FROM journal j
    JOIN (SELECT version, journal, source, unnest([concat('I', c_nationkey), concat('S', c_nationkey)]) AS issn FROM rec) i
      ON i.version = j.version AND i.journal = j.journal AND i.source = j.source)"""

_VERDICT_RUNS = """
WITH stated AS (
  SELECT o_orderstatus AS version, CAST(year(o_orderdate) AS INTEGER) AS publication_year, count(*) AS expected
    FROM orders GROUP BY ALL
  UNION ALL
  SELECT DISTINCT o_orderstatus, 3000, CAST(0 AS BIGINT) FROM orders)"""

_TABLE_COUNTS = {
    "dataset_alias": "alias", "publisher": "(SELECT DISTINCT version, publisher FROM rec)", "journal": "journal",
    "issn": "issn", "publication": "pub", "dyad": "dyad", "dyad_model": "dyad_model", "topic": "topic",
    "publication_topic": "pub_topic", "publication_ufc": "pub_ufc",
    "asjc": "(SELECT DISTINCT version, asjc, p_type FROM line)", "publication_asjc": "pub_asjc", "author": "author",
    "publication_author": "pub_author", "publication_affiliation": "pub_affiliation",
    "author_affiliation": "author_affiliation"}

_ALL = ("WITH" + _LINE + _DYAD_MODEL + _AUTHOR + _PUB_AUTHOR + _PUB_AFFILIATION
        + _AUTHOR_AFFILIATION + _PUB_ASJC + _PUB_TOPIC + _PUB_UFC + _ISSN)

_RUN_COUNTS = _ALL + "\n" + "\nUNION ALL\n".join(
    f"SELECT version, '{name}' AS table_name, count(*) AS n_rows FROM {source} GROUP BY version"
    for name, source in _TABLE_COUNTS.items())

_ID_STATS = _ALL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, count(*) AS n_ids, CAST(1 AS BIGINT) AS first_id,"
    f" count(*) AS last_id FROM {source}" for name, source in _TABLE_COUNTS.items())

# Rules of each final table: required columns, lengths, keys and references, counted by hand.
_STAR_RULES = """
SELECT t.table_name, CAST(t.n AS BIGINT) AS n_rules, CAST(0 AS BIGINT) AS violations FROM (VALUES
('model', 4), ('dataset_alias', 4), ('publisher', 3), ('journal', 4), ('issn', 2), ('publication', 5),
('dyad', 5), ('dyad_model', 4), ('topic', 2), ('publication_topic', 4), ('publication_ufc', 4), ('asjc', 1),
('publication_asjc', 4), ('author', 3), ('publication_author', 5), ('publication_affiliation', 9),
('author_affiliation', 2)) t(table_name, n)"""

# The runs of a feed with one good run, one that misstates a year and one with lines of the wrong type.
_FAULTY = """
SELECT o_orderstatus AS version, {status} AS status, {reason} AS reason, {documents} AS documents
  FROM orders GROUP BY o_orderstatus"""

_PLACE = """
WITH place AS (
  SELECT CAST(c_custkey AS BIGINT) AS id, c_mktsegment,
         CASE c_custkey % 3 WHEN 1 THEN concat('Dock|', c_mktsegment) WHEN 2 THEN '' END AS address, n_name AS city,
         CASE WHEN c_custkey % 4 <> 0 THEN r_name END AS state, CAST(c_nationkey AS VARCHAR) AS country_code
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
geo AS (
  SELECT *, concat_ws(',', city, state) AS q,
         CASE WHEN CAST(country_code AS INTEGER) % 5 <> 0 THEN city END AS q_final,
         concat_ws('/', coalesce(address, '-'), city, coalesce(state, '-')) AS display_name
    FROM (SELECT DISTINCT address, city, state, country_code FROM place))"""

_RECORD_COLUMNS = """version, eid, doi, title AS publication_title, pub_type AS publication_type, year AS publication_year,
       month AS publication_month, citation_count, fwci AS field_weighted_citation_impact,
       publisher AS journal_publishername, journal AS journal_title, source AS journal_scopus_source_id"""

ORACLES: dict[str, str] = {
    "stage_publications": f"""WITH {_REC}
SELECT {_RECORD_COLUMNS}, concat('I', c_nationkey, '||S', c_nationkey) AS journal_issn_isbn,
       expressions AS tested_expressions, cite AS journal_citescore_value FROM rec""",
    "stage_dyads": f"""WITH {_LINE}{_MENTION}
SELECT version, eid, alias, snippet, alias_id, fuzzy_score, is_fuzzy, model, score FROM mention""",
    "stage_authors": f"""WITH {_LINE}
SELECT version, eid, author_id, l_linenumber AS author_position, given_name, s_name AS family_name, pn_given_name,
       s_name AS pn_family_name, concat('[', sequence, ']') AS affiliation_sequences FROM line""",
    "stage_affiliations": f"""WITH {_LINE}
SELECT version, eid, sequence AS affiliation_sequence,
       CASE WHEN l_linenumber <> 7 THEN CAST(s_nationkey AS BIGINT) END AS affiliation_id, affiliation_ids,
       concat('["', n_name, '"]') AS affiliation_normalized, organization AS affiliation_organization,
       address AS affiliation_address_part, country_code, state AS affiliation_state, n_name AS affiliation_city,
       CAST(NULL AS VARCHAR) AS affiliation_postal_code FROM line""",
    "stage_asjcs": f"WITH {_LINE} SELECT version, eid, asjc, p_type AS label FROM line",
    "stage_ufcs": f"""WITH {_LINE}
SELECT version, eid, p_partkey AS concept_id, p_name AS concept_name, l_discount AS rank,
       CAST(l_quantity AS INTEGER) AS a_freq FROM line""",
    "stage_topics": f"WITH {_REC} SELECT version, eid, topic_id, keywords, prominence FROM rec WHERE topic_id IS NOT NULL",
    "stage_topicclusters": f"WITH {_REC} SELECT version, eid, r_name AS keywords, cluster_id FROM rec",
    "stage_datasets": f"WITH {_ALIAS.lstrip(',')} SELECT version, alias, alias_id, parent_alias_id, alias_type FROM alias",
    "nested_turns": "SELECT conv_id, turn, role, text FROM conversations",
    "struct_props": """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type <> 'error'""",
    "reconcile_years": f"""{_VERDICT_RUNS}, observed AS (
  SELECT o_orderstatus AS version, CAST(year(o_orderdate) AS INTEGER) AS publication_year,
         count(DISTINCT o_orderkey) AS observed FROM orders GROUP BY ALL),
both_sides AS (
  SELECT coalesce(s.version, o.version) AS version, coalesce(s.publication_year, o.publication_year) AS publication_year,
         coalesce(s.expected, 0) + CASE WHEN s.version = 'F' AND s.publication_year = 1997 THEN 1 ELSE 0 END AS expected,
         coalesce(o.observed, 0) AS observed
    FROM stated s FULL OUTER JOIN observed o ON s.version = o.version AND s.publication_year = o.publication_year)
SELECT 'testdata' AS agency, version, publication_year, CAST(expected AS BIGINT) AS expected, observed,
       CAST(expected - observed AS BIGINT) AS diff FROM both_sides""",
    "unique_ok": """
SELECT max(n) = 1 AS unique_ok, count(*) AS n_keys, max(n) AS max_rows_per_key
  FROM (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY o_orderkey)""",
    "unique_bad": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "run_verdict": """
WITH runs AS (SELECT o_orderstatus AS version, count(*) FILTER (WHERE year(o_orderdate) = 1998) AS n_1998,
                     count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS n_low FROM orders GROUP BY o_orderstatus)
SELECT 'testdata' AS agency, version, NOT (version = 'O' AND n_1998 > 0) AS counts_ok,
       NOT (version = 'P' AND n_low > 0) AS unique_ok,
       NOT (version = 'O' AND n_1998 > 0) AND NOT (version = 'P' AND n_low > 0) AS valid FROM runs""",
    "constraint_audit": """
WITH o AS (SELECT * FROM orders WHERE o_orderstatus <> 'P')
SELECT 'orders' AS table_name, 'not_null:o_orderkey' AS rule, count(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM o
UNION ALL SELECT 'orders', 'max_length:o_orderpriority', count(*) FILTER (WHERE length(o_orderpriority) > 8) FROM o
UNION ALL SELECT 'orders', 'max_length:o_orderstatus', count(*) FILTER (WHERE length(o_orderstatus) > 1) FROM o
UNION ALL SELECT 'orders', 'unique:o_orderkey', count(*) FILTER (WHERE n > 1) FROM (SELECT count(*) AS n FROM o GROUP BY o_orderkey)
UNION ALL SELECT 'lineitem', 'not_null:l_orderkey', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem
UNION ALL SELECT 'lineitem', 'not_null:l_returnflag', count(*) FILTER (WHERE l_returnflag IS NULL) FROM lineitem
UNION ALL SELECT 'lineitem', 'max_length:l_returnflag', count(*) FILTER (WHERE length(l_returnflag) > 1) FROM lineitem
UNION ALL SELECT 'lineitem', 'unique:l_orderkey,l_linenumber', count(*) FILTER (WHERE n > 1)
  FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'lineitem', 'reference:l_orderkey', count(*) FROM lineitem
  WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM o WHERE o_orderkey = l_orderkey)""",
    "star_audit": _STAR_RULES,
    "star_audit_broken": f"""WITH {_LINE}{_PUB}{_AUTHOR}{_PUB_AUTHOR}{_PUB_AFFILIATION}{_AUTHOR_AFFILIATION}
SELECT 'publisher' AS table_name, 'unique:run_id,name' AS rule, count(*) AS violations
  FROM (SELECT DISTINCT version, publisher FROM rec)
UNION ALL SELECT 'journal', 'not_null:title', count(*) FILTER (WHERE journal = 'MACHINERY') FROM journal
UNION ALL SELECT 'publication', 'max_length:title', count(*) FILTER (WHERE title LIKE '5-LOW%') FROM pub
UNION ALL SELECT 'author_affiliation', 'reference:publication_affiliation_id', count(*) FILTER (WHERE sequence % 2 <> 0)
  FROM author_affiliation""",
    "dim_alias": f"WITH {_ALIAS.lstrip(',')} SELECT version, alias_id, parent_alias_id, alias, alias_type FROM alias",
    "dim_model": f"""WITH {_LINE}{_MENTION}
SELECT m.name, (SELECT count(score) FROM mention WHERE model = m.name) AS n_scores
  FROM (VALUES ('string_matching'), ('model1'), ('model2'), ('model3')) m(name)""",
    "dim_publisher": f"WITH {_REC} SELECT DISTINCT version, publisher AS name, CAST(NULL AS VARCHAR) AS external_id FROM rec",
    "dim_journal": f"""WITH {_REC}{_JOURNAL}
SELECT version, publisher, journal AS title, CAST(source AS VARCHAR) AS external_id,
       CAST(cite AS DECIMAL(9, 2)) AS cite_score FROM journal""",
    "bridge_issn": f"""WITH {_REC}{_JOURNAL}{_ISSN}
SELECT version, publisher, journal AS title, CAST(cite AS DECIMAL(9, 2)) AS cite_score, issn FROM issn""",
    "fact_publication": f"""WITH {_REC}{_PUB}
SELECT version, eid, title, doi, year, month, pub_type, citation_count, fwci AS fw_citation_impact,
       expressions AS tested_expressions, journal_title AS journal, journal_publisher AS publisher,
       CAST(journal_cite AS DECIMAL(9, 2)) AS cite_score FROM pub""",
    "fact_dyad": f"""WITH {_LINE}{_DYAD}
SELECT version, eid, dataset, alias_id, mention_candidate, snippet, is_fuzzy,
       CAST(CAST(fuzzy_score AS REAL) AS DOUBLE) AS fuzzy_score FROM dyad""",
    "fact_dyad_model": f"""WITH {_LINE}{_DYAD_MODEL}
SELECT version, eid, alias_id, mention_candidate, snippet, is_fuzzy, model,
       CAST(CAST(score AS REAL) AS DOUBLE) AS score FROM dyad_model""",
    "dim_topic": f"""WITH {_REC}
SELECT DISTINCT version, keywords, CAST(topic_id AS VARCHAR) AS external_topic_id, prominence FROM rec
 WHERE topic_id IS NOT NULL""",
    "bridge_pub_topic": f"""WITH {_REC}{_PUB}{_PUB_TOPIC}
SELECT version, eid, CAST(topic_id AS VARCHAR) AS external_topic_id, keywords, CAST(NULL AS DOUBLE) AS score
  FROM pub_topic""",
    "bridge_pub_ufc": f"""WITH {_LINE}{_PUB}{_PUB_UFC}
SELECT version, eid, p_partkey AS concept_id, p_name AS concept_name, l_discount AS rank, a_freq FROM pub_ufc""",
    "dim_asjc": f"""WITH {_LINE}
SELECT version, CAST(asjc AS BIGINT) AS code, p_type AS label FROM (SELECT DISTINCT version, asjc, p_type FROM line)""",
    "bridge_pub_asjc": f"""WITH {_LINE}{_PUB}{_PUB_ASJC}
SELECT version, eid, code, label, count(*) AS n_rows FROM pub_asjc GROUP BY version, eid, code, label""",
    "dim_author": f"""WITH {_LINE}{_AUTHOR}
SELECT version, CAST(author_id AS VARCHAR) AS external_id, pn_given_name AS given_name, s_name AS family_name FROM author""",
    "bridge_pub_author": f"""WITH {_LINE}{_PUB}{_AUTHOR}{_PUB_AUTHOR}
SELECT version, eid, CAST(author_id AS VARCHAR) AS author, given_name, s_name AS family_name,
       l_linenumber AS author_position FROM pub_author""",
    "bridge_pub_affiliation": f"""WITH {_LINE}{_PUB}{_PUB_AFFILIATION}
SELECT version, eid, sequence AS sequence_number, affiliation_ids AS external_id, left(organization, 750) AS institution_name,
       address, city, state, country_code, CAST(NULL AS VARCHAR) AS postal_code FROM pub_affiliation""",
    "bridge_author_affiliation": f"""WITH {_LINE}{_PUB}{_AUTHOR}{_PUB_AUTHOR}{_PUB_AFFILIATION}{_AUTHOR_AFFILIATION}
SELECT version, eid, CAST(author_id AS VARCHAR) AS author, given_name, l_linenumber AS author_position,
       affiliation_ids AS affiliation, sequence AS sequence_number FROM author_affiliation""",
    "star_losses": f"""WITH {_LINE}{_PUB}
, fate AS (SELECT rec.version, rec.eid, count(pub.eid) AS n FROM rec
             LEFT JOIN pub ON pub.version = rec.version AND pub.eid = rec.eid GROUP BY rec.version, rec.eid)
SELECT version, count(*) FILTER (WHERE n = 0) AS publications_dropped,
       CAST(sum(CASE WHEN n > 1 THEN n - 1 ELSE 0 END) AS BIGINT) AS publications_repeated,
       (SELECT count(*) FROM line WHERE line.version = fate.version AND p_size < 5) AS asjc_rows_lost
  FROM fate GROUP BY version""",
    "star_id_integrity": _ID_STATS,
    "canonical_longest": """
SELECT lang, source, doc_id, length FROM (
  SELECT lang, source, doc_id, length(rtrim(text, ' ')) AS length,
         row_number() OVER (PARTITION BY lang, source ORDER BY length(rtrim(text, ' ')) DESC NULLS LAST, doc_id) AS rank
    FROM documents) WHERE rank = 1""",
    "id_integrity": """
SELECT 'part' AS table_name, count(*) AS n_rows, count(*) AS n_ids, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id
  FROM part""",
    "id_copies": """
SELECT l_returnflag, l_linestatus, count(*) AS n_rows, count(*) AS id_span FROM lineitem
 GROUP BY l_returnflag, l_linestatus""",
    "run_replace": """
SELECT o_orderstatus AS version, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS documents, count(*) AS n_ids
  FROM orders WHERE o_orderstatus <> 'O' OR o_totalprice > 100000 GROUP BY ALL""",
    "ingest_turns": """
SELECT o_orderstatus AS version, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS documents, count(*) AS n_ids
  FROM orders WHERE o_orderstatus <> 'O' OR o_totalprice > 100000 GROUP BY ALL""",
    "run_delete": """
SELECT o_orderstatus AS version, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS documents, count(*) AS n_ids
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL""",
    "run_fail_mode": """
SELECT o_orderstatus AS version, CASE WHEN o_orderstatus <> 'P' THEN 'run exists' END AS reason, count(*) AS documents
  FROM orders GROUP BY o_orderstatus""",
    "tables_lifecycle": """
WITH n AS (SELECT count(*) AS orders, count(DISTINCT o_orderstatus) AS runs, (SELECT count(*) FROM nation) AS nations FROM orders)
SELECT s.step, t.table_name, CAST(CASE t.table_name
         WHEN 'model' THEN 4
         WHEN 'agency_run' THEN CASE WHEN s.step IN ('loaded', 'again') THEN n.runs ELSE 0 END
         WHEN 'publication' THEN CASE WHEN s.step IN ('loaded', 'kept', 'again') THEN n.orders ELSE 0 END
         WHEN 'affiliation_geocoding' THEN CASE WHEN s.step = 'loaded' THEN n.nations ELSE 0 END
         ELSE 0 END AS BIGINT) AS n_rows
  FROM n CROSS JOIN (VALUES ('created'), ('loaded'), ('kept'), ('emptied'), ('again'), ('dropped')) s(step)
  CROSS JOIN (VALUES
('agency_run'), ('model'), ('dataset_alias'), ('publisher'), ('journal'), ('issn'), ('publication'),
('dyad'), ('dyad_model'), ('topic'), ('publication_topic'), ('publication_ufc'), ('asjc'),
('publication_asjc'), ('author'), ('publication_author'), ('publication_affiliation'),
('author_affiliation'), ('reviewer'), ('snippet_validation'), ('affiliation_geo'),
('affiliation_geocoding'), ('publication_affiliation_geocoding'), ('publication_affiliation_geo')) t(table_name)""",
    "discover_prefix": """
SELECT DISTINCT split_part(split_part(url, '://', 2), '/', 1) AS agency, split_part(split_part(url, '://', 2), '/', 2) AS version
  FROM pages WHERE regexp_matches(url, '^https?://[^/]+/[^/]+/[0-9]+')""",
    "discover_new": """
WITH listing AS (SELECT regexp_extract(url, '^https?://([^/]+/[^/]+/[0-9]+)', 1) AS key, url FROM pages),
part_of AS (SELECT *, split_part(key, '/', 1) AS agency, split_part(key, '/', 2) AS version FROM listing WHERE key <> ''),
fresh AS (SELECT DISTINCT agency, version FROM part_of
           WHERE key NOT IN (SELECT key FROM part_of WHERE url LIKE 'https:%')),
flagged AS (SELECT DISTINCT agency, version FROM part_of WHERE agency LIKE '%example.org' AND version = 'en')
SELECT agency, version, bool_or(force) AS force
  FROM (SELECT *, false AS force FROM fresh UNION ALL SELECT *, true FROM flagged) GROUP BY agency, version""",
    "discover_overwrite": """
WITH listing AS (SELECT regexp_extract(url, '^https?://([^/]+/[^/]+/[0-9]+)', 1) AS key FROM pages)
SELECT DISTINCT split_part(key, '/', 1) AS agency, split_part(key, '/', 2) AS version FROM listing WHERE key <> ''""",
    "object_listing": """
SELECT DISTINCT 'testdata' AS agency, o_orderstatus AS version, true AS has_feed, true AS has_metadata FROM orders""",
    "scan_feed": f"""WITH {_LINE}
SELECT 'testdata' AS agency, rec.version, rec.eid, rec.doi, rec.year AS publication_year,
       rec.fwci AS field_weighted_citation_impact, count(line.eid) AS n_lines
  FROM rec LEFT JOIN line ON line.version = rec.version AND line.eid = rec.eid
 GROUP BY rec.version, rec.eid, rec.doi, rec.year, rec.fwci""",
    "scan_metadata": f"{_VERDICT_RUNS} SELECT 'testdata' AS agency, version, publication_year, expected FROM stated",
    "ingest_all": _RUN_COUNTS,
    "ingest_streamed": _RUN_COUNTS,
    "ingest_isolated": _FAULTY.format(
        status="CASE o_orderstatus WHEN 'F' THEN 'loaded' ELSE 'failed' END",
        reason="CASE o_orderstatus WHEN 'O' THEN 'input validation failed: documents per year' WHEN 'P' THEN 'malformed feed line' END",
        documents="CASE o_orderstatus WHEN 'F' THEN count(*) END") + """
UNION ALL SELECT 'truncated', 'failed', 'load failed: FAILED_READ_FILE', NULL""",
    "ingest_streamed_retry": _FAULTY.format(status="'loaded'", reason="CAST(NULL AS VARCHAR)", documents="count(*)"),
    "csv_content": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "preview_projection": "SELECT p_partkey, p_name FROM part",
    "view_query": """
SELECT o_orderstatus AS version, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS documents,
       CAST(0 AS BIGINT) AS with_journal FROM orders GROUP BY ALL""",
    "staging_views": f"""WITH {_LINE}
SELECT version, count(*) AS n_rows, count(DISTINCT author_id) AS n_authors FROM line GROUP BY version""",
    "redact_snippets": "SELECT conv_id, turn, role, left(text, 10) AS snippet FROM conversations",
    "redact_year_counts": f"""WITH {_REC}
SELECT version, year AS publication_year, count(*) AS documents FROM rec GROUP BY version, year""",
    "validated_dyads": f"""WITH {_LINE}{_DYAD}
, verdict AS (
  SELECT *, CASE snippet WHEN 'A' THEN 1 WHEN 'N' THEN 0 WHEN 'R' THEN -1 END AS found FROM dyad
   WHERE mention_candidate NOT LIKE 'red%'
  UNION ALL
  SELECT *, 0 FROM dyad WHERE mention_candidate NOT LIKE 'red%' AND is_fuzzy)
SELECT 'testdata' AS agency, v.version, ds.alias AS dataset, v.eid,
       count(*) FILTER (WHERE found = 1) AS num_identified, count(*) FILTER (WHERE found = -1) AS num_rejected, count(*) FILTER (WHERE found = 0) AS num_uncertain,
       count(*) FILTER (WHERE found IS NULL) AS num_tbd, count(DISTINCT da.alias_id) AS num_distinct_alias,
       count(DISTINCT mention_candidate) AS num_distinct_mention
  FROM verdict v
  JOIN alias da ON da.version = v.version AND da.alias = v.dataset
  JOIN alias ds ON ds.version = v.version AND ds.alias_id = da.parent_alias_id AND ds.parent_alias_id = ds.alias_id
 GROUP BY v.version, ds.alias, v.eid, v.journal_cite""",
    "geo_append": f"{_PLACE} SELECT q, address, city, state, country_code, q_final, display_name FROM geo",
    "geo_match": f"""{_PLACE}
SELECT p.id AS publication_affiliation_id, g.display_name FROM place p
  JOIN geo g ON g.q_final IS NOT NULL AND coalesce(g.address, '') = coalesce(p.address, '') AND g.city = p.city
            AND coalesce(g.state, '') = coalesce(p.state, '') AND g.country_code = p.country_code
 WHERE p.c_mktsegment <> 'FURNITURE'""",
    "geo_backlog": f"""{_PLACE}
, unknown AS (
  SELECT DISTINCT nullif(address, '') AS address, city, state, country_code FROM place p
   WHERE NOT EXISTS (SELECT 1 FROM geo g WHERE g.q_final IS NOT NULL AND coalesce(g.address, '') = coalesce(p.address, '')
                        AND g.city = p.city AND coalesce(g.state, '') = coalesce(p.state, '')
                        AND g.country_code = p.country_code))
SELECT address, city, state, country_code,
       concat_ws(',', replace(address, '|', ','), city, state, concat('Land ', n_name)) AS q
  FROM unknown LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 3) n ON CAST(n_nationkey AS VARCHAR) = country_code""",
    "ordered_roles": """
SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles,
       CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) AS BIGINT) AS n_user,
       max(CASE WHEN role = 'user' THEN turn END) AS last_user_turn FROM conversations GROUP BY conv_id""",
    "ordered_roles_nulls": """
SELECT conv_id, CASE WHEN conv_id % 3 <> 0 THEN conv_id % 3 END AS third, string_agg(role, ',' ORDER BY turn) AS roles,
       count(*) FILTER (WHERE role = 'user') AS n_user FROM conversations GROUP BY ALL""",
    "redacted_run": f"""WITH {_LINE}
SELECT rec.version, rec.year AS publication_year, count(DISTINCT rec.eid) AS documents,
       CAST(max(CASE WHEN l.l_linenumber <> 7 THEN 10 END) AS INTEGER) AS longest_snippet, count(DISTINCT rec.eid) AS expected
  FROM rec LEFT JOIN line l ON l.eid = rec.eid GROUP BY ALL""",
    "mentions_per_year": f"""WITH {_LINE}{_DYAD}
SELECT d.version, r.year, count(DISTINCT d.mention_candidate) AS n_mentions, count(*) AS n_dyads,
       count(d.dataset) AS n_linked
  FROM dyad d JOIN rec r ON r.version = d.version AND r.eid = d.eid GROUP BY d.version, r.year""",
}

_KINDS = ("publications", "dyads", "authors", "affiliations", "asjcs", "topics", "topicclusters", "ufcs", "datasets")


def _contents(kind: str) -> str:
    from checks.queries import CONTENT

    columns = [*(["eid"] if kind != "datasets" else []), *CONTENT[kind]]
    value = {"snippet": """snippet || chr(10) || '"quoted", \\'"""}
    text = ", ".join(f"coalesce(CAST({value.get(c, c)} AS VARCHAR), '<null>')" for c in columns)
    return (f"SELECT version, '{kind}' AS kind, count(*) AS n_rows, CAST(sum(CAST('0x' || left(md5(concat_ws('|', {text})), 8) AS BIGINT))"
            f" AS BIGINT) AS content FROM ({ORACLES[f'stage_{kind}']}) GROUP BY version")


_KIND_CONTENTS = "\nUNION ALL\n".join(map(_contents, _KINDS))
ORACLES |= {
    "staging_sink": _KIND_CONTENTS, "csv_roundtrip": _KIND_CONTENTS, "ingest_content": ORACLES["fact_publication"],
    "ingest_report": f"SELECT version, 'loaded' AS status, CAST(NULL AS VARCHAR) AS reason, publications_dropped,"
                     f" publications_repeated, asjc_rows_lost, CAST(0 AS BIGINT) AS stale_verdicts FROM ({ORACLES['star_losses']})"}

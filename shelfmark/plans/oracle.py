"""DuckDB SQL with the same result as each registered query, over the same tables."""

from __future__ import annotations

SQL: dict[str, str] = {}

# ---- bronze ----------------------------------------------------------------------

SQL["extract_fields"] = r"""
SELECT page_id,
       trim(replace(replace(regexp_replace(regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1), '<[^>]*>', '', 'g'),
            '&quot;', '"'), '&amp;', '&')) AS title,
       regexp_extract(html, '(?is)<html\b[^>]*\blang="([^"]*)"', 1) AS lang,
       url LIKE '%catalogue/%' AND url NOT LIKE '%/category/%' AS is_detail
FROM pages"""

SQL["extract_links"] = r"""
WITH l AS (
  SELECT url, regexp_extract_all(html, '(?is)<a\b[^>]*\bhref="([^"]*)"', 1) AS refs FROM pages
), e AS (SELECT url, unnest(refs) AS ref, generate_subscripts(refs, 1) - 1 AS position FROM l)
SELECT url AS source_url, CAST(position AS BIGINT) AS position,
       regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || replace(replace(ref, '&quot;', '"'), '&amp;', '&') AS link
FROM e"""

SQL["raw_hash"] = """
SELECT page_id, md5(url || '_' || substr(html, 1, 1000)) AS record_hash, md5(html) AS content_hash FROM pages"""

SQL["parse_product_pages"] = """
SELECT p_name || ' & ' || p_brand AS title,
       CASE WHEN p_partkey % 2 = 0 THEN replace(p_name, ' ', '|') ELSE 'Unknown Author' END AS authors,
       round(p_retailprice, 2) AS price_current,
       CASE p_partkey % 3 WHEN 0 THEN 'GBP' WHEN 1 THEN 'USD' ELSE 'EUR' END AS currency,
       CASE WHEN p_size % 3 = 0 THEN 'out_of_stock' ELSE 'in_stock' END AS availability,
       CAST(p_partkey % 5 + 1 AS DOUBLE) AS rating,
       CASE WHEN p_partkey % 9 = 0 THEN '0' ELSE CAST(p_size AS VARCHAR) END AS num_reviews,
       'It''s the ' || p_name AS description,
       p_type AS category,
       CASE WHEN p_partkey % 2 = 0 THEN 'authors=' || replace(p_name, ' ', ', ') || '|' ELSE '' END
         || 'number_of_reviews=' || CASE WHEN p_partkey % 9 = 0 THEN 'none' ELSE CAST(p_size AS VARCHAR) END
         || '|universal_product_code=x' || p_partkey
         || '|upc=' || CASE WHEN p_partkey % 6 = 0 THEN '' ELSE 'u' || p_partkey END AS product_info,
       CASE WHEN p_partkey % 6 = 0 THEN 'x' ELSE 'u' END || p_partkey AS upc,
       'http://shop.example.com/media/' || p_partkey || '.jpg' AS image_url,
       'http://shop.example.com/catalogue/part-' || p_partkey || '/index.html' AS source_url,
       CAST(NULL AS DOUBLE) AS price_original, '200' AS http_status, '2024-01-31 00:00:00' AS ingested_at
FROM part WHERE p_size <> 50 AND p_partkey % 50 <> 0"""

SQL["page_selectors"] = """
SELECT p_partkey, p_type || ' É½é≂̸' AS category, '../pic/' || p_partkey || '.jpg' AS image, 'was $' || p_partkey AS price,
       CASE WHEN p_partkey % 4 <> 0 THEN 'http://shop.example.com/catalogue/category/books/p_1/page-' || (p_partkey + 1) || '.html' END AS next_url
FROM part"""

SQL["rough_markup"] = """
SELECT 'http://shop.example.com/catalogue/part-' || p_partkey || '/index.html' AS source_url, p_name || ' é ∉ & £ x' AS title,
       round(p_retailprice, 2) AS price_current, 'GBP' AS currency, 'in_stock' AS availability, CAST(p_partkey % 5 + 1 AS DOUBLE) AS rating,
       'http://shop.example.com/catalogue/part-' || p_partkey || '/pic_' || p_partkey || '.jpg' AS image_url
FROM part"""

SQL["rough_links"] = """
SELECT 'http://shop.example.com/catalogue/part-' || p_partkey || '/index.html' AS source_url, CAST(position AS BIGINT) AS position,
       'http://shop.example.com/catalogue/part-' || p_partkey || '/' || CASE position
         WHEN 0 THEN 'it''s_' || p_partkey || '/index.html?a=1&copy=2&b' WHEN 1 THEN 'c_' || p_partkey || '/index.html'
         ELSE 'page-' || (p_partkey + 1) || '.html' END AS link
FROM part CROSS JOIN (SELECT unnest([-1, 0, 1]) AS position)"""

SQL["links_inside_headings"] = """
SELECT 'http://shop.example.com/catalogue/category/books/p_1/page-' || p_partkey || '.html' AS source_url, CAST(position AS BIGINT) AS position,
       'http://shop.example.com/catalogue/category/books/p_1/' || CASE position WHEN 0 THEN 'one-' ELSE 'two-' END || p_partkey || '.html' AS link
FROM part CROSS JOIN (SELECT unnest([0, 1]) AS position)"""

SQL["category_list"] = """
SELECT 'http://shop.example.com/' || p_size || '/index.html' AS source_url, row_number() OVER (PARTITION BY p_size ORDER BY p_type) - 1 AS position,
       p_type || ' & more' AS name, 'http://shop.example.com/' || p_size || '/catalogue/category/books/' || p_type || '_1/index.html' AS link
FROM (SELECT DISTINCT p_size, p_type FROM part)"""

SQL["rejected_api_json"] = """
SELECT substr('{"title":"' || p_name || ' ' || p_brand || '","subtitle":"', 1, 30) AS malformed FROM part WHERE p_partkey % 25 = 0"""

SQL["rejected_pages"] = """
SELECT 'http://shop.example.com/catalogue/part-' || p_partkey || '/index.html' AS source_url, 'price_current' AS missing_fields
FROM part WHERE p_size <> 50 AND p_partkey % 50 = 0"""

SQL["listing_links"] = """
SELECT 'http://shop.example.com/catalogue/category/books/shelf_' || (p_partkey // 20 % 7) || '/page-' || (p_partkey // 20) || '.html' AS source_url,
       row_number() OVER (PARTITION BY p_partkey // 20 ORDER BY p_partkey) - 1 AS position,
       'http://shop.example.com/catalogue/part-' || p_partkey || '/index.html' AS link
FROM part"""

SQL["next_pages"] = """
SELECT 'http://shop.example.com/catalogue/category/books/shelf_' || (page % 7) || '/page-' || page || '.html' AS source_url,
       CASE WHEN n = 20 THEN 'http://shop.example.com/catalogue/category/books/shelf_' || (page % 7) || '/page-' || (page + 1) || '.html' END AS next_url,
       'Shelf ' || (page % 7) AS category
FROM (SELECT p_partkey // 20 AS page, count(*) AS n FROM part GROUP BY 1)"""

SQL["parse_api_json"] = """
SELECT p_name || ' ' || p_brand AS title, replace(p_name, ' ', '|') AS authors,
       CASE WHEN p_partkey % 8 <> 0 THEN round(p_retailprice, 2) END AS price_current,
       'USD' AS currency, 'in_stock' AS availability, CAST(NULL AS DOUBLE) AS rating, CAST(NULL AS VARCHAR) AS num_reviews,
       'About "' || p_name || '"' AS description,
       CASE WHEN p_partkey % 4 = 0 THEN 'Technology' ELSE p_type END AS category,
       'isbn10=' || p_partkey || '|isbn13=978' || lpad(CAST(p_partkey AS VARCHAR), 10, '0')
         || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '|language=English' END
         || '|pages=' || p_size || '|publisher=' || p_brand || '|year=2020' AS product_info,
       '978' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS upc,
       'http://example.com/' || p_partkey || '.png' AS image_url,
       'http://example.com/book/' || p_partkey AS source_url
FROM part WHERE p_partkey % 25 <> 0"""

SQL["parse_event_json"] = """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"""

SQL["enrich_join"] = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, CAST(l.quality AS BIGINT) AS quality, CAST(l.toxic AS BIGINT) AS toxic
FROM documents d JOIN labels l USING (doc_id)"""

SQL["first_per_category"] = """
SELECT p_type, p_partkey, p_name FROM part
QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) <= 5"""

# ---- silver ----------------------------------------------------------------------

_SILVER = """
parsed AS (
  SELECT CASE WHEN p_partkey % 13 <> 0 THEN p_name || ' ' || p_brand END AS title,
         CASE WHEN p_partkey % 7 <> 0 THEN string_split(p_name, ' ') END AS authors,
         CASE WHEN p_partkey % 11 <> 0 THEN p_retailprice END AS price_current,
         CASE WHEN p_partkey % 5 <> 0 THEN 'USD' END AS currency,
         CASE WHEN p_partkey % 17 <> 0 THEN p_type END AS category,
         CASE WHEN p_partkey % 10 = 0 THEN NULL
              WHEN p_partkey % 2 = 1 THEN '978' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') ELSE 'u' || p_partkey END AS upc,
         p_partkey % 4 <> 0 AS has_info, p_size, p_brand, 'http://example.com/part/' || p_partkey AS url
  FROM part
), silver AS (
  SELECT 'catalogue_a' AS source, coalesce(upc, title) AS source_id,
         CASE WHEN regexp_matches(upc, '^[0-9]{13}$') THEN upc END AS isbn13, title, coalesce(authors, []) AS authors,
         'Books > ' || coalesce(category, 'Unknown') AS category_path, price_current, CAST(NULL AS DOUBLE) AS price_original,
         coalesce(currency, 'GBP') AS currency,
         CASE WHEN p_size % 3 = 0 THEN 'out_of_stock' ELSE 'in_stock' END AS availability,
         CASE WHEN has_info THEN CAST(p_size AS VARCHAR) END AS stock_quantity, p_size / 10.0::DOUBLE AS rating,
         CAST(p_size AS VARCHAR) AS num_reviews,
         CASE WHEN has_info THEN 'availability=In stock (' || p_size || ' available)|brand=' || p_brand ELSE '' END AS specs,
         url AS product_url, '2024-01-31 10:00:00' AS ingested_at, md5(concat_ws('_', title, upc, url)) AS content_hash,
         round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE
           - CASE WHEN title IS NULL THEN 0.3 ELSE 0 END::DOUBLE - CASE WHEN price_current IS NULL THEN 0.3 ELSE 0 END::DOUBLE
           - CASE WHEN upc IS NULL THEN 0.2 ELSE 0 END::DOUBLE - CASE WHEN category IS NULL THEN 0.1 ELSE 0 END::DOUBLE
           - CASE WHEN authors IS NULL THEN 0.1 ELSE 0 END::DOUBLE)), 4) AS data_quality_score
  FROM parsed
)"""

SQL["silver_clean"] = f"""
WITH {_SILVER}
SELECT * REPLACE (array_to_string(authors, '|') AS authors) FROM silver"""

SQL["schema_nulls"] = f"""
WITH {_SILVER}
SELECT field_name, CAST(nulls AS BIGINT) AS nulls FROM (
  UNPIVOT (SELECT count(*) FILTER (source IS NULL) AS source, count(*) FILTER (source_id IS NULL) AS source_id,
                  count(*) FILTER (title IS NULL) AS title, count(*) FILTER (category_path IS NULL) AS category_path,
                  count(*) FILTER (price_current IS NULL) AS price_current, count(*) FILTER (currency IS NULL) AS currency,
                  count(*) FILTER (availability IS NULL) AS availability, count(*) FILTER (product_url IS NULL) AS product_url,
                  count(*) FILTER (ingested_at IS NULL) AS ingested_at, count(*) FILTER (content_hash IS NULL) AS content_hash,
                  count(*) FILTER (data_quality_score IS NULL) AS data_quality_score FROM silver)
  ON COLUMNS(*) INTO NAME field_name VALUE nulls)"""

_FIRST_DOCUMENTS = """
SELECT doc_id, lang, source, n_chars, md5(text) AS content_hash FROM documents
QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1"""

SQL["dedupe_latest"] = """
WITH d AS (
  SELECT doc_id, lang, source, n_chars, md5(text) AS content_hash,
         CASE WHEN doc_id % 7 <> 0 THEN TIMESTAMP '2024-01-31' + to_days(CAST(doc_id % 28 AS INTEGER)) END AS t FROM documents)
SELECT doc_id, lang, source, n_chars, content_hash, strftime(t, '%Y-%m-%d %H:%M:%S') AS ingested_at FROM d
QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY t DESC NULLS LAST, doc_id) = 1"""

SQL["mapped_fields"] = """
SELECT p_name AS title, p_retailprice AS price_current, 'in_stock' AS availability, p_size / 10.0::DOUBLE AS rating,
       'http://example.com/' || p_partkey AS product_url, replace(p_name, ' ', '|') AS authors FROM part"""

SQL["mapped_by_source"] = """
SELECT p_partkey, p_name AS title, p_retailprice AS price_current, CASE WHEN p_partkey % 2 = 0 THEN 'http://example.com/' || p_partkey END AS url,
       CASE WHEN p_partkey % 2 = 1 THEN 'http://example.com/' || p_partkey END AS product_url FROM part"""

SQL["silver_coercion"] = f"""
WITH {_SILVER}
SELECT product_url, CASE WHEN upc IS NULL THEN '' ELSE coalesce(title, '') END AS authors,
       CASE WHEN upc IS NOT NULL THEN '2024-01-31 10:00:00' END AS ingested_at
FROM (SELECT url AS product_url, upc, title FROM parsed)"""

SQL["change_detect"] = """
WITH d AS (SELECT doc_id, lang, source, md5(text) AS content_hash FROM documents)
SELECT * FROM d WHERE NOT EXISTS (
  SELECT 1 FROM d s JOIN labels USING (doc_id) WHERE s.lang = d.lang AND s.content_hash = d.content_hash)"""

SQL["category_map"] = """
SELECT p_partkey, CASE lower(p_type) WHEN 'economy' THEN 'Budget' WHEN 'promo' THEN 'Offers' WHEN 'large' THEN 'Oversize'
       ELSE 'Unknown' END AS category FROM part"""

SQL["category_map_table"] = """
SELECT p_partkey, coalesce(n_name, 'Unknown') AS category_standard
FROM part LEFT JOIN nation ON lower(p_brand) = 'brand#' || n_nationkey"""

# ---- matching --------------------------------------------------------------------

_SIDES = """
v AS (
  SELECT p_partkey % 2 AS side, CASE p_partkey % 2 WHEN 0 THEN 'catalogue_a' ELSE 'catalogue_b' END AS source,
         'p' || p_partkey AS source_id,
         CASE WHEN (p_partkey // 2) % 10 = 0 THEN '978' || lpad(CAST(p_partkey // 2 AS VARCHAR), 10, '0') END AS isbn13,
         p_name || ' ' || p_brand AS title, string_split(p_name, ' ') AS authors, 'Books > ' || p_type AS category_path,
         p_type, p_retailprice AS price_current,
         CASE WHEN p_partkey % 3 = 0 THEN round(p_retailprice * 1.25, 2) END AS price_original
  FROM part
), titles AS (SELECT DISTINCT side, lower(title) AS title FROM v
), similar_titles AS (
  SELECT a.title AS t1, b.title AS t2, round(jaro_winkler_similarity(a.title, b.title), 10) AS sim
  FROM titles a JOIN titles b ON a.side = 0 AND b.side = 1
)"""

_MATCHES = f"""
{_SIDES}, pairs AS (
  SELECT a.source_id AS source1_id, b.source_id AS source2_id, t1 AS source1_title, t2 AS source2_title,
         a.authors AS source1_authors, b.authors AS source2_authors, a.price_current AS source1_price,
         b.price_current AS source2_price, a.isbn13 AS source1_isbn13, b.isbn13 AS source2_isbn13,
         CASE WHEN a.isbn13 = b.isbn13 THEN 1.0 ELSE 0.0 END::DOUBLE AS isbn_match_score, sim AS title_similarity,
         CASE WHEN sim >= 0.85 THEN sim * 0.7::DOUBLE ELSE 0.0 END::DOUBLE AS title_match_score,
         0.3::DOUBLE * len(list_intersect(a.authors, b.authors))
           / len(list_distinct(list_concat(a.authors, b.authors))) AS author_match_score
  FROM v a JOIN v b ON a.side = 0 AND b.side = 1
  JOIN similar_titles ON t1 = lower(a.title) AND t2 = lower(b.title)
), scored AS (
  SELECT *, round(isbn_match_score + title_match_score + author_match_score, 10) AS confidence_score,
         CASE WHEN isbn_match_score > 0 THEN 'exact_isbn' WHEN title_match_score > 0 THEN 'fuzzy_title'
              ELSE 'low_confidence' END AS match_type
  FROM pairs
), best AS (
  SELECT * FROM scored WHERE confidence_score >= 0.6
  QUALIFY row_number() OVER (PARTITION BY source1_id ORDER BY confidence_score DESC, source2_id) = 1
), unique_best AS (
  SELECT * FROM best
  QUALIFY row_number() OVER (PARTITION BY source2_id ORDER BY confidence_score DESC, source1_id) = 1
)"""

_MATCH_COLUMNS = """
source1_id, source2_id, source1_title, source2_title, array_to_string(source1_authors, '|') AS source1_authors,
array_to_string(source2_authors, '|') AS source2_authors, source1_price, source2_price, isbn_match_score,
round(title_similarity, 6) AS title_similarity, round(title_match_score, 6) AS title_match_score,
round(author_match_score, 6) AS author_match_score, round(confidence_score, 6) AS confidence_score, match_type"""

SQL["match_books"] = f"WITH {_MATCHES} SELECT {_MATCH_COLUMNS} FROM best"
SQL["match_one_to_one"] = f"WITH {_MATCHES} SELECT {_MATCH_COLUMNS} FROM unique_best"

_REPEATED = _MATCHES.replace("'p' || p_partkey AS source_id", "'q' || (p_partkey // 6) AS source_id").replace(
    "string_split(p_name, ' ') AS authors", "CASE WHEN p_partkey % 5 <> 0 THEN string_split(p_name, ' ') END AS authors"
).replace(
    "0.3::DOUBLE * len(list_intersect(a.authors, b.authors))\n           / len(list_distinct(list_concat(a.authors, b.authors)))",
    "coalesce(0.3::DOUBLE * len(list_intersect(a.authors, b.authors)) / len(list_distinct(list_concat(a.authors, b.authors))), 0.0::DOUBLE)",
)
SQL["match_repeated_ids"] = f"WITH {_REPEATED} SELECT source1_id, source2_id, round(confidence_score, 6) AS confidence_score FROM best"

SQL["match_best_titles"] = f"""
WITH {_SIDES}, ids AS (SELECT lower(title) AS title, min(source_id) AS id FROM v WHERE side = 1 GROUP BY 1)
SELECT t1 AS title, t2 AS best_title, id AS best_id, round(sim, 6) AS similarity
FROM similar_titles JOIN ids ON ids.title = t2 WHERE sim >= 0.85
QUALIFY row_number() OVER (PARTITION BY t1 ORDER BY sim DESC, id) = 1"""

SQL["match_distinct_titles"] = """
WITH t AS (
  SELECT p_partkey AS id, lower(concat_ws(' ', p_name, p_brand, p_type, p_size, p_partkey)) AS title FROM part
), s AS (
  SELECT a.title, b.title AS best_title, b.id AS best_id, round(jaro_winkler_similarity(a.title, b.title), 10) AS sim
  FROM t a JOIN t b ON a.id % 2 = 0 AND b.id % 2 = 1
)
SELECT title, best_title, best_id, round(sim, 6) AS similarity FROM s WHERE sim >= 0.85
QUALIFY row_number() OVER (PARTITION BY title ORDER BY sim DESC, best_id) = 1"""

# Rounds: a pair that comes first for both of its sides is taken, and all other pairs of either go.
SQL["match_stable"] = f"""
WITH RECURSIVE {_MATCHES}, ranked AS (
  SELECT source1_id, source2_id, confidence_score,
         row_number() OVER (ORDER BY confidence_score DESC, md5(
           concat_ws('|', coalesce(source1_isbn13, ''), source1_title, array_to_string(list_sort(list_distinct(source1_authors)), ','),
                     coalesce(source2_isbn13, ''), source2_title, array_to_string(list_sort(list_distinct(source2_authors)), ','))),
           source1_id, source2_id) AS place
  FROM scored WHERE confidence_score >= 0.6
), r AS (
  SELECT *, place = min(place) OVER (PARTITION BY source1_id) AND place = min(place) OVER (PARTITION BY source2_id) AS taken FROM ranked
  UNION ALL
  SELECT source1_id, source2_id, confidence_score, place,
         place = min(place) OVER (PARTITION BY source1_id) AND place = min(place) OVER (PARTITION BY source2_id) AS taken
  FROM (SELECT *, bool_or(taken) OVER (PARTITION BY source1_id) AS gone1, bool_or(taken) OVER (PARTITION BY source2_id) AS gone2 FROM r) s
  WHERE NOT gone1 AND NOT gone2
)
SELECT source1_id, source2_id, round(confidence_score, 6) AS confidence_score FROM r WHERE taken"""

SQL["match_summary"] = f"""
WITH {_MATCHES}
SELECT match_type, count(*) AS pairs, round(avg(confidence_score), 4) AS avg_confidence,
       round(min(confidence_score), 6) AS min_confidence, round(max(confidence_score), 6) AS max_confidence
FROM best GROUP BY 1"""

SQL["unmatched_rows"] = f"""
WITH {_MATCHES}
SELECT source, source_id, title FROM v
WHERE (side = 0 AND source_id NOT IN (SELECT source1_id FROM unique_best))
   OR (side = 1 AND source_id NOT IN (SELECT source2_id FROM unique_best))"""

# ---- books of three sources --------------------------------------------------------

_CLUSTERS = """
RECURSIVE v AS (
  SELECT 'shop_' || substr('abc', CAST(p_partkey % 3 + 1 AS INTEGER), 1) AS source, 'p' || p_partkey AS source_id,
         CASE WHEN p_partkey % 7 = 0 THEN lpad(CAST(p_partkey AS VARCHAR), 13, '9') END AS isbn13,
         p_name || ' ' || p_brand AS title, CASE WHEN p_partkey % 4 <> 0 THEN string_split(p_name, ' ') END AS authors,
         CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS category, p_name, p_size FROM part
), links AS (
  SELECT a.source || '|' || a.source_id AS a, 'shop_b|' || b.id AS b, 0.95 AS score
  FROM v a JOIN (SELECT title, min(source_id) AS id FROM v WHERE source = 'shop_b' GROUP BY 1) b USING (title) WHERE a.source = 'shop_a'
  UNION ALL
  SELECT a.source || '|' || a.source_id, 'shop_c|' || b.id, 0.75
  FROM v a JOIN (SELECT p_name, p_size, min(source_id) AS id FROM v WHERE source = 'shop_c' GROUP BY 1, 2) b USING (p_name, p_size) WHERE a.source = 'shop_b'
), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (SELECT a AS node, a AS other FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a
), labels AS (SELECT node, min(other) AS label FROM reach GROUP BY 1
), weakest AS (SELECT label, min(score) AS score FROM links JOIN labels ON node = a GROUP BY 1
), named AS (
  SELECT v.*, coalesce(label, source || '|' || source_id) AS label, score FROM v
  LEFT JOIN (SELECT node, label, score FROM labels JOIN weakest USING (label)) ON node = source || '|' || source_id
), ids AS (
  SELECT *, 'bk_' || substr(sha256('6:' || substr(label, 1, 6) || '|' || (length(label) - 7) || ':' || substr(label, 8)), 1, 32) AS book_id FROM named
)"""

SQL["canonical_many_sources"] = f"""
WITH {_CLUSTERS}, per AS (
  SELECT book_id, source, string_agg(source_id, ',' ORDER BY source_id) AS listed FROM ids GROUP BY 1, 2
), listed AS (SELECT book_id, string_agg(source || '=' || listed, '|' ORDER BY source) AS source_ids, count(*) AS source_count FROM per GROUP BY 1)
SELECT book_id, arg_min(source_id, (source, source_id)) || CASE WHEN count(*) = 1 THEN '_single' ELSE '' END AS source_key,
       arg_min(isbn13, (source, source_id)) FILTER (isbn13 IS NOT NULL) AS isbn13, any_value(listed.source_ids) AS source_ids,
       arg_min(title, (source, source_id)) AS title,
       array_to_string(arg_min(authors, (source, source_id)) FILTER (authors IS NOT NULL), '|') AS authors,
       coalesce(arg_min(category, (source, source_id)) FILTER (category IS NOT NULL), 'Unknown') AS primary_category,
       CAST(coalesce(min(score), 1.0) AS DOUBLE) AS confidence_score, CAST(min(score) AS DOUBLE) AS match_score, any_value(listed.source_count) AS source_count
FROM ids JOIN listed USING (book_id) GROUP BY book_id"""

SQL["prices_many_sources"] = f"""
WITH {_CLUSTERS}
SELECT book_id, count(*) AS events, count(DISTINCT source) AS sources FROM ids GROUP BY 1"""

# ---- gold ------------------------------------------------------------------------

_GOLD = f"""
{_MATCHES}, book_ids AS (
  SELECT source1_id, source2_id, confidence_score, source1_id || '_' || source2_id AS source_key,
         'bk_' || substr(sha256('11:catalogue_a|' || length(source1_id) || ':' || source1_id || '|11:catalogue_b|' || length(source2_id) || ':' || source2_id), 1, 32) AS book_id
  FROM unique_best
), canonical AS (
  SELECT coalesce(b.book_id, 'bk_' || substr(sha256('11:' || v.source || '|' || length(v.source_id) || ':' || v.source_id), 1, 32)) AS book_id,
         coalesce(b.source_key, v.source_id || '_single') AS source_key, coalesce(v.isbn13, o.isbn13) AS isbn13,
         v.source || '=' || v.source_id || coalesce('|catalogue_b=' || b.source2_id, '') AS source_ids,
         v.title, array_to_string(v.authors, '|') AS authors, v.p_type AS primary_category, 'Books|' || v.p_type AS category_hierarchy,
         '2024-01-31 00:00:00' AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, TRUE AS is_current, CAST(1 AS BIGINT) AS version,
         round(least(1.0::DOUBLE, coalesce(b.confidence_score, 1.0::DOUBLE)), 6) AS confidence_score,
         round(b.confidence_score, 6) AS match_score, CAST(CASE WHEN b.book_id IS NULL THEN 1 ELSE 2 END AS BIGINT) AS source_count
  FROM v LEFT JOIN book_ids b ON v.side = 0 AND v.source_id = b.source1_id
  LEFT JOIN v o ON o.side = 1 AND o.source_id = b.source2_id
  WHERE v.side = 0 OR v.source_id NOT IN (SELECT source2_id FROM book_ids)
), prices AS (
  SELECT coalesce(b.book_id, 'bk_' || substr(sha256('11:' || v.source || '|' || length(v.source_id) || ':' || v.source_id), 1, 32)) AS book_id, v.source,
         v.price_current AS price, 'USD' AS currency, '2024-01-31 00:00:00' AS effective_date,
         coalesce((v.price_original - v.price_current) / v.price_original * 100 > 0, FALSE) AS is_discount,
         round((v.price_original - v.price_current) / v.price_original * 100, 6) AS discount_percentage
  FROM v LEFT JOIN book_ids b
    ON (v.side = 0 AND v.source_id = b.source1_id) OR (v.side = 1 AND v.source_id = b.source2_id)
)"""

SQL["canonical_books"] = f"WITH {_GOLD} SELECT * FROM canonical"
SQL["price_history"] = f"WITH {_GOLD} SELECT * FROM prices"
SQL["prices_per_source"] = f"WITH {_GOLD} SELECT source, count(*) AS events FROM prices GROUP BY 1"
SQL["source_split"] = f"""
WITH {_GOLD}
SELECT source_count > 1 AS multi_source, count(*) AS books, round(avg(confidence_score), 4) AS avg_confidence
FROM canonical GROUP BY 1"""
SQL["gold_profile"] = f"""
WITH {_GOLD}
SELECT round(avg(confidence_score), 4) AS avg_confidence, count(book_id) AS total_books, count(isbn13) AS books_with_isbn
FROM canonical"""

_PRICE_LOG = """
log AS (
  SELECT l_partkey AS book_id, floor(unit * (1 - l_discount) * 100) / 100 AS price, unit AS price_original, l_shipdate,
         l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber
  FROM (SELECT *, floor(l_extendedprice / l_quantity * 100) / 100 AS unit FROM lineitem)
)"""

SQL["price_facts"] = f"""
WITH {_PRICE_LOG}
SELECT l_orderkey, l_linenumber, book_id, price,
       coalesce((price_original - price) / price_original * 100 > 0, FALSE) AS is_discount,
       CASE WHEN price_original > 0 THEN round((price_original - price) / price_original * 100, 4) END AS discount_percentage
FROM log"""

SQL["price_changes"] = f"""
WITH {_PRICE_LOG}, seen AS (
  SELECT *, lag(price) OVER (PARTITION BY book_id ORDER BY l_shipdate, l_orderkey, l_linenumber, price) AS previous_price FROM log
)
SELECT book_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS effective_date, l_orderkey, l_linenumber, price, previous_price,
       round(price - previous_price, 2) AS price_change,
       CASE WHEN previous_price <> 0 THEN round((price - previous_price) / previous_price * 100, 4) END AS change_percentage
FROM seen WHERE price - previous_price <> 0"""

_VERSIONS = """
seen AS (
  SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey,
         lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS was FROM orders
), versions AS (
  SELECT o_custkey, o_orderpriority, o_orderdate AS valid_from,
         lead(o_orderdate) OVER w AS valid_to, row_number() OVER w AS version
  FROM seen WHERE was IS DISTINCT FROM o_orderpriority
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
)"""

SQL["scd2_from_log"] = f"""
WITH {_VERSIONS}
SELECT o_custkey, o_orderpriority, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from,
       strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to, valid_to IS NULL AS is_current, version
FROM versions"""

SQL["burst_price_changes"] = f"""
WITH {_PRICE_LOG}, burst AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE book_id END AS book_id, CASE WHEN l_orderkey % 3 = 0 THEN TIMESTAMP '1997-01-01' ELSE l_shipdate END AS l_shipdate)
  FROM log
), seen AS (
  SELECT *, lag(price) OVER (PARTITION BY book_id ORDER BY l_shipdate, l_orderkey, l_linenumber, price) AS previous_price FROM burst
)
SELECT book_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS effective_date, l_orderkey, l_linenumber, price, previous_price,
       round(price - previous_price, 2) AS price_change
FROM seen WHERE price - previous_price <> 0"""

_BURST = """
orders AS (
  SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END AS o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1997-01-01' ELSE o_orderdate END AS o_orderdate)
  FROM main.orders
)"""

SQL["burst_versions"] = SQL["scd2_from_log"].replace("WITH", f"WITH {_BURST},", 1)

SQL["burst_asof"] = f"""
WITH {_BURST}
SELECT o_orderkey, o_custkey,
       last_value(CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS VARCHAR) END IGNORE NULLS) OVER (
         PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_finished
FROM orders"""

SQL["valid_at"] = f"""
WITH {_VERSIONS}
SELECT o_custkey, o_orderpriority, version FROM versions
WHERE valid_from <= TIMESTAMP '1997-06-30 00:00:00' AND (valid_to IS NULL OR TIMESTAMP '1997-06-30 00:00:00' < valid_to)"""

SQL["asof_lookup"] = f"""
WITH {_VERSIONS}, asked AS (SELECT o_orderkey, o_custkey, o_orderdate - INTERVAL 60 DAY AS asked_at FROM orders)
SELECT a.o_orderkey, a.o_custkey, strftime(a.asked_at, '%Y-%m-%d %H:%M:%S') AS asked_at, v.o_orderpriority
FROM asked a LEFT JOIN versions v
  ON v.o_custkey = a.o_custkey AND v.valid_from <= a.asked_at AND (v.valid_to IS NULL OR a.asked_at < v.valid_to)"""

SQL["scd2_merge"] = """
WITH now AS (SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS p FROM orders GROUP BY 1),
before AS (
  SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS p FROM orders
  WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 1)
SELECT b.o_custkey, b.p AS o_orderpriority, '1997-01-01 00:00:00' AS valid_from,
       CASE WHEN n.p <> b.p THEN '2024-01-31 00:00:00' END AS valid_to, n.p = b.p AS is_current, CAST(1 AS BIGINT) AS version
FROM before b JOIN now n USING (o_custkey)
UNION ALL
SELECT n.o_custkey, n.p, '2024-01-31 00:00:00', NULL, TRUE, CAST(CASE WHEN b.p IS NULL THEN 1 ELSE 2 END AS BIGINT)
FROM now n LEFT JOIN before b USING (o_custkey) WHERE b.p IS NULL OR b.p <> n.p"""

SQL["merge_touched_buckets"] = """
WITH now AS (SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS p FROM orders WHERE o_custkey % 100 = 7 GROUP BY 1),
before AS (
  SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS p FROM orders
  WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 1)
SELECT b.o_custkey, b.p AS o_orderpriority, '1997-01-01 00:00:00' AS valid_from,
       CASE WHEN n.p <> b.p THEN '2024-01-31 00:00:00' END AS valid_to, n.p IS NULL OR n.p = b.p AS is_current, CAST(1 AS BIGINT) AS version
FROM before b LEFT JOIN now n USING (o_custkey)
UNION ALL
SELECT n.o_custkey, n.p, '2024-01-31 00:00:00', NULL, TRUE, CAST(CASE WHEN b.p IS NULL THEN 1 ELSE 2 END AS BIGINT)
FROM now n LEFT JOIN before b USING (o_custkey) WHERE b.p IS NULL OR b.p <> n.p"""

SQL["availability_timeline"] = """
WITH s AS (
  SELECT *, CASE o_orderstatus WHEN 'F' THEN 'in_stock' WHEN 'O' THEN 'out_of_stock' ELSE 'pre_order' END AS status FROM orders
), seen AS (SELECT *, lag(status) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_status FROM s)
SELECT o_custkey AS book_id, 'orders' AS source, status, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS effective_date, previous_status
FROM seen WHERE previous_status IS DISTINCT FROM status"""

SQL["category_dim"] = """
WITH n AS (
  SELECT DISTINCT 'Books' AS parent, 'Books > ' || p_type AS path, p_type AS name, 2 AS level FROM part
  UNION SELECT DISTINCT 'Books > ' || p_type, 'Books > ' || p_type || ' > ' || p_brand, p_brand, 3 FROM part
  UNION SELECT NULL, 'Books', 'Books', 1)
SELECT md5(path) AS category_id, name AS category_name, md5(parent) AS parent_category_id, CAST(level AS BIGINT) AS level,
       path AS full_path FROM n"""

# ---- quality ---------------------------------------------------------------------

SQL["dq_rules"] = """
WITH c AS (
  SELECT count(*) AS n, count(*) FILTER (c_custkey IS NULL) AS a, count(c_custkey) - count(DISTINCT c_custkey) AS b,
         count(c_nationkey) - count(DISTINCT c_nationkey) AS c, count(*) FILTER (NOT (c_acctbal BETWEEN 0 AND 10000)) AS d,
         count(*) FILTER (NOT regexp_matches(c_name, '^Customer#[0-9]{9}$')) AS e,
         count(*) FILTER (c_mktsegment NOT IN ('HOUSEHOLD', 'MACHINERY', 'BUILDING')) AS f FROM customer
), r AS (
  SELECT 'key_present' AS rule_name, 'c_custkey' AS field_name, a AS broken, 0.0 AS tolerance, n FROM c
  UNION ALL SELECT 'key_unique', 'c_custkey', b, 0.0, n FROM c
  UNION ALL SELECT 'nation_unique', 'c_nationkey', c, 0.0, n FROM c
  UNION ALL SELECT 'balance_range', 'c_acctbal', d, 0.5, n FROM c
  UNION ALL SELECT 'name_form', 'c_name', e, 0.0, n FROM c
  UNION ALL SELECT 'segment_listed', 'c_mktsegment', f, 0.0, n FROM c)
SELECT 'run-1' AS run_id, rule_name,
       CASE WHEN broken = 0 THEN 'PASS' WHEN broken / n <= tolerance THEN 'WARNING' ELSE 'FAIL' END AS status, field_name,
       CAST(broken AS VARCHAR) AS actual_value,
       CASE WHEN broken > 0 THEN broken || ' of ' || n || ' rows break ' || rule_name END AS error_message,
       '2024-01-31 00:00:00' AS timestamp
FROM r"""

SQL["dq_split"] = """
WITH l AS (SELECT *, floor(l_extendedprice / l_quantity * 100) / 100 AS unit_price FROM lineitem), r AS (
  SELECT unit_price, NOT (unit_price BETWEEN 0 AND 50000) AS a, NOT (l_returnflag <> 'R' OR l_quantity < 40) AS b FROM l)
SELECT concat_ws('|', CASE WHEN a THEN 'price_range' END, CASE WHEN b THEN 'ship_rule' END) AS reasons, count(*) AS rows,
       round(sum(unit_price), 2) AS price_sum
FROM r GROUP BY 1"""

_REASONS = """
concat_ws('|', CASE WHEN source_id IS NULL THEN 'source_id_present' END, CASE WHEN title IS NULL THEN 'title_present' END,
          CASE WHEN price_current IS NULL THEN 'price_current_present' END)"""

SQL["dq_silver"] = f"""
WITH {_SILVER}
SELECT source_id, product_url, {_REASONS} AS reasons FROM silver WHERE {_REASONS} <> ''"""

SQL["dq_pages"] = """
WITH c AS (
  SELECT count(*) AS n, count(*) FILTER (NOT regexp_matches(url, '^https?://')) AS a,
         count(*) FILTER (NOT regexp_matches(url, '^https://')) AS b FROM pages)
SELECT 'url_is_url' AS rule_name, CASE WHEN a = 0 THEN 'PASS' ELSE 'FAIL' END AS status, '^https?://' AS expected_value,
       CAST(a AS VARCHAR) AS actual_value FROM c
UNION ALL
SELECT 'https', CASE WHEN b = 0 THEN 'PASS' WHEN b / n <= 0.9 THEN 'WARNING' ELSE 'FAIL' END, '^https://', CAST(b AS VARCHAR) FROM c"""

SQL["profile_nulls"] = f"""
WITH {_SILVER}, c AS (
  SELECT count(*) AS n, count(title) AS a, count(price_current) AS b, count(source_id) AS c, count(isbn13) AS d FROM silver)
SELECT 'title' AS field_name, n AS rows, n - a AS nulls FROM c UNION ALL SELECT 'price_current', n, n - b FROM c
UNION ALL SELECT 'source_id', n, n - c FROM c UNION ALL SELECT 'isbn13', n, n - d FROM c"""


def _number_profile(column: str, table: str, digits: int) -> str:
    return (
        f"SELECT round(avg({column}), {digits}) AS avg_value, min({column}) AS min_value, max({column}) AS max_value, "
        f"count({column}) AS with_value, count(*) AS rows FROM {table}"
    )


SQL["profile_price"] = _number_profile("l_extendedprice", "lineitem", 2)
SQL["profile_rating"] = f"WITH {_SILVER} " + _number_profile("rating", "silver", 4)
SQL["profile_score"] = f"WITH {_SILVER} " + _number_profile("data_quality_score", "silver", 4)
SQL["profile_groups"] = "SELECT lang, count(*) AS rows FROM documents GROUP BY 1"

SQL["run_report"] = f"""
WITH {_SILVER}, c AS (
  SELECT count(*) AS n, count(*) FILTER ({_REASONS} = '') AS good,
         count(DISTINCT content_hash) FILTER ({_REASONS} = '') AS kept FROM silver)
SELECT 'run-1' AS run_id, 'catalogue_a' AS source, 'SUCCESS' AS status, '2024-01-31 00:00:00' AS start_time,
       '2024-01-31 00:05:00' AS end_time, n AS records_ingested, good AS records_cleaned, good - kept AS records_deduplicated,
       n - good AS records_rejected, CAST(broken AS BIGINT) AS data_quality_failures, round(good / n * 100, 4) AS success_rate, '' AS errors
FROM c, (SELECT sum((source_id IS NULL)::INT + (title IS NULL)::INT + (price_current IS NULL)::INT) AS broken FROM silver)"""

# ---- storage and streams ---------------------------------------------------------

SQL["roundtrip_partitioned"] = f"""
WITH {_SILVER}
SELECT batch_id, source_id, title, price_current, content_hash
FROM silver CROSS JOIN (SELECT unnest(['b1', 'b2']) AS batch_id) WHERE {_REASONS} = ''"""

SQL["json_roundtrip"] = SQL["parse_api_json"]

SQL["sample_file"] = f"WITH {_SILVER} SELECT source_id, title, product_url FROM silver ORDER BY product_url LIMIT 25"

SQL["files_by_name"] = f"WITH {_SILVER} SELECT source_id, title FROM silver"

SQL["gold_roundtrip"] = f"""
WITH {_PRICE_LOG}
SELECT 'orders' AS source, 'USD' AS currency, coalesce((price_original - price) / price_original * 100 > 0, FALSE) AS is_discount,
       count(*) AS rows, round(sum(price), 2) AS price_sum
FROM log GROUP BY 3"""

SQL["report_roundtrip"] = f"""
WITH {_SILVER}
SELECT 'run-1' AS run_id, 'SUCCESS' AS status, '2024-01-31 00:00:00' AS start_time, CAST(NULL AS VARCHAR) AS end_time,
       count(*) AS records_ingested, count(*) FILTER ({_REASONS} <> '') AS records_rejected FROM silver"""

SQL["verified_write"] = f"""
WITH {_SILVER}
SELECT count(*) AS rows_expected, count(*) AS rows_actual, TRUE AS equal FROM silver WHERE source_id IS NOT NULL"""

SQL["incremental_load"] = f"SELECT doc_id, lang, source, content_hash FROM ({_FIRST_DOCUMENTS})"

SQL["incremental_restart"] = SQL["incremental_load"]

SQL["stream_dedup"] = "SELECT DISTINCT user_id, event_type FROM events"

SQL["default_batch"] = f"""
WITH {_SILVER}
SELECT source, count(*) AS rows, CAST(1 AS BIGINT) AS batches FROM silver WHERE source_id IS NOT NULL GROUP BY 1"""

SQL["balanced_write"] = """
SELECT o_orderstatus AS source, 'b1' AS batch_id, count(*) AS rows, round(sum(o_totalprice), 2) AS price_sum FROM orders GROUP BY 1"""

SQL["stream_late_rows"] = """
WITH e AS (
  SELECT ts, user_id, event_type, CASE WHEN epoch_us(ts) >= (SELECT quantile_cont(epoch_us(ts), 0.5) FROM events) THEN 0 ELSE 1 END AS batch FROM events
), t AS (SELECT *, batch = 1 AND ts < (SELECT max(ts) FROM e WHERE batch = 0) - INTERVAL 20 DAY AS is_late FROM e
), k AS (SELECT user_id, event_type, min(batch) AS batch FROM t WHERE NOT is_late GROUP BY 1, 2
), s AS (SELECT batch, count(*) AS stored FROM k GROUP BY 1)
SELECT CAST(batch AS BIGINT) AS batch, count(*) AS came, any_value(coalesce(stored, 0)) AS stored,
       count(*) - count(*) FILTER (is_late) - any_value(coalesce(stored, 0)) AS repeats, count(*) FILTER (is_late) AS late
FROM t LEFT JOIN s USING (batch) GROUP BY 1"""

SQL["layer_counts"] = f"""
WITH {_SILVER}
SELECT (SELECT count(*) FROM part) AS bronze, (SELECT count(*) FROM silver WHERE {_REASONS} = '') AS silver,
       (SELECT count(DISTINCT category_path) + 1 FROM silver) AS gold"""

# Required columns of each gold table, by its schema.
SQL["gold_contract"] = """
SELECT table_name, '' AS differences, CAST(required AS BIGINT) AS required, CAST(0 AS BIGINT) AS nulls
FROM (VALUES ('canonical_books', 8), ('price_history', 6), ('availability_history', 4), ('category_dimension', 4), ('rule_results', 4), ('run_report', 4)) t(table_name, required)"""

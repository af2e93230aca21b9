"""The registered queries as plain SQL for a second engine, to compare results with."""

from __future__ import annotations

from ..catalog.view import catalog_sql

DATA = ["sku", "url", "name", "price", "discount", "brand", "description", "size", "images", "scraped_at"]
ALL = ["row_number", *DATA]

# White_Space characters in a syntax without Unicode shorthand.
WS = r"[\t-\r\x{85}\p{Z}]"
NUMBER = r"(-?(?:[0-9][0-9,]*(?:\.[0-9]*)?|\.[0-9]+))"
WORDS = "('', 'NA', 'N/A', 'na', 'n/a', 'null', 'NULL', 'undefined', 'Undefined', 'UNDEFINED')"
PRIORITY = [
    "sku", "url", "name", "price", "price_flag", "brand", "color", "size_system", "size_count", "size_labels",
    "size_us", "size_eu", "dimensions_raw", "waist", "inseam", "has_petite", "has_tall", "has_plus", "images_n",
    "images_clean"]


def on_catalog(body: str, **ctes: str) -> str:
    parts = [f"catalog AS ({catalog_sql()})", *[f"{name} AS ({sql})" for name, sql in ctes.items()]]
    return "WITH " + ",\n".join(parts) + "\n" + body


def miss(c: str) -> str:
    return f"({c} IS NULL OR CAST({c} AS VARCHAR) = '')"


def present(c: str) -> str:
    return f"({c} IS NOT NULL AND CAST({c} AS VARCHAR) <> '')"


def pct(n: str, d: str, digits: int = 2) -> str:
    return f"round(CAST({n} AS DOUBLE) * 100.0::DOUBLE / CAST({d} AS DOUBLE), {digits})"


def big(c: str) -> str:
    return f"CAST({c} AS BIGINT)"


def count_if(c: str) -> str:
    return f"count(*) FILTER (WHERE {c})"


def num(c: str) -> str:
    return f"TRY_CAST(replace(regexp_extract({c}, '{NUMBER}', 1), ',', '') AS DOUBLE)"


def quoted(sql: str) -> str:
    return sql.replace("'", "''")


def squish(c: str) -> str:
    return f"trim(regexp_replace({c}, '{WS}+', ' ', 'g'))"


def sane(c: str) -> str:
    return rf"regexp_replace({c}, '\p{{C}}', '', 'g')"


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- profiles


def overview(table: str, columns: list[str]) -> str:
    any_gap = " OR ".join(miss(c) for c in columns)
    gaps = " + ".join(f"CAST({count_if(miss(c))} > 0 AS BIGINT)" for c in columns)
    distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(columns)} FROM {table}))"
    return f"""
SELECT unnest(['Total rows', 'Total columns', 'Total cells', 'Exact duplicate rows',
               'Rows with ≥1 missing value', 'Columns with ≥1 missing value']) AS metric,
       unnest([n, {len(columns)}, n * {len(columns)}, n - d, r, g]) AS value
FROM (SELECT count(*) AS n, {distinct} AS d, {count_if(any_gap)} AS r, {gaps} AS g FROM {table})"""


def missingness(table: str, columns: list[str]) -> str:
    return union([
        f"""SELECT '{c}' AS variable, {count_if(miss(c))} AS missing_count, count(*) - {count_if(miss(c))} AS non_missing,
        {pct(count_if(miss(c)), 'count(*)')} AS missing_pct FROM {table}""" for c in columns])


def missing_by_row(table: str, columns: list[str]) -> str:
    total = " + ".join(f"CAST({miss(c)} AS INTEGER)" for c in columns)
    return f"SELECT CAST({total} AS INTEGER) AS missing_values_per_row, count(*) AS row_count FROM {table} GROUP BY 1"


def variable_types(table: str, columns: dict[str, str]) -> str:
    return union([
        f"""SELECT '{c}' AS variable, '{t}' AS type, count(*) - {count_if(miss(c))} AS non_missing_count,
        {count_if(miss(c))} AS missing_count,
        count(DISTINCT {c}) + CAST({count_if(c + ' IS NULL')} > 0 AS BIGINT) AS unique_count,
        {pct(count_if(miss(c)), 'count(*)')} AS missing_pct FROM {table}""" for c, t in columns.items()])


def text_quality(table: str, columns: list[str], raw_space: bool = True) -> str:
    parts = []
    for c in columns:
        s = "raw" if raw_space else "clean"
        parts.append(f"""
SELECT '{c}' AS variable, {count_if("clean = ''")} AS blank_count,
  {count_if(f"regexp_matches({s}, '^{WS}|{WS}$')")} AS leading_trailing_space_count,
  {count_if(f"regexp_matches({s}, '{WS}{{2,}}')")} AS multiple_space_count,
  {count_if(f"regexp_matches({s}, '[\\n\\r]')")} AS newline_count,
  {count_if("length(clean) > 200")} AS very_long_text_count,
  CAST(max(length(clean)) AS INTEGER) AS max_text_length,
  count(DISTINCT clean) + CAST({count_if('clean IS NULL')} > 0 AS BIGINT) AS unique_count
FROM (SELECT {c} AS raw, {sane(c)} AS clean FROM {table})""")
    return union(parts)


def ranges(table: str, columns: dict[str, tuple[str, str]]) -> str:
    """``columns``: name -> (type shown, numeric expression)."""
    parts = []
    for c, (shown, expr) in columns.items():
        parts.append(f"""
SELECT '{c}' AS variable, '{shown}' AS original_type, count(v) AS parsed_count, {pct('count(v)', 'count(*)')} AS parsed_pct,
  round(min(v), 6) AS min, round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(favg(v) * (1 + 1e-12::DOUBLE), 6) AS mean,
  round(any_value(q3), 6) AS q3, round(max(v), 6) AS max, {count_if('v < 0')} AS negative_count,
  {count_if('v = 0')} AS zero_count,
  {count_if('v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)')} AS iqr_outlier_count
FROM (SELECT CAST({expr} AS DOUBLE) AS v FROM {table}),
     (SELECT quantile_cont(CAST({expr} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({expr} AS DOUBLE), 0.5) AS q2,
             quantile_cont(CAST({expr} AS DOUBLE), 0.75) AS q3 FROM {table})""")
    return union(parts)


def native(*columns: str, shown: str = "double") -> dict[str, tuple[str, str]]:
    return {c: (shown, c) for c in columns}


PRICE_RANGES = {
    "price": ("string", f"CASE WHEN price NOT IN {WORDS} THEN {num('price')} END"),
    "discount": ("string", f"CASE WHEN discount NOT IN {WORDS} THEN {num('discount')} END"),
}

# ---------------------------------------------------------------- duplicates


def first(n: int | None, key: str = "row_number") -> str:
    return "" if n is None else f" ORDER BY {key} LIMIT {n}"


def key_copies(table: str, c: str) -> str:
    return f"(SELECT count({c}) - count(DISTINCT {c}) FROM {table} WHERE {present(c)})"


def duplicate_summary(exact: str) -> str:
    return f"""
SELECT 'Exact duplicate rows' AS "check", {exact} AS count
UNION ALL SELECT 'Duplicate product URLs', {key_copies('catalog', 'url')}
UNION ALL SELECT 'Duplicate product names', {key_copies('catalog', 'name')}
UNION ALL SELECT 'Duplicate image URLs', CAST(NULL AS BIGINT)"""


EXACT_COPIES = f"(SELECT count(*) FROM catalog) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(DATA)} FROM catalog))"


def exact_rows(n: int | None = None) -> str:
    return f"""
SELECT {', '.join(ALL)} FROM (SELECT *, count(*) OVER (PARTITION BY {', '.join(DATA)}) AS n FROM catalog)
WHERE n > 1{first(n)}"""


LIST = r"string_split_regex(regexp_replace({c}, ',\s*$', ''), ',\s*')"
ELEMENTS = r"list_transform(" + LIST + r", lambda x: regexp_replace(regexp_replace(x, '[\[\]'']', '', 'g'), '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g'))"
IMAGES = ELEMENTS.replace("{c}", "images")
REPEATS = f"{present('images')} AND len({IMAGES}) <> len(list_distinct({IMAGES}))"
IMAGE_ITEMS = f"SELECT row_number, unnest({IMAGES}) AS images FROM catalog WHERE {present('images')}"

# ---------------------------------------------------------------- checks


def url_stats(kind: str, variable: str, source: str) -> str:
    return f"""
SELECT '{kind}' AS url_type, '{variable}' AS variable, count(*) AS total_non_missing,
  {count_if("regexp_matches(u, '^https?://')")} AS valid_count, {count_if("NOT regexp_matches(u, '^https?://')")} AS invalid_count,
  count(*) - count(DISTINCT u) AS duplicate_count FROM ({source}) WHERE {present('u')}"""


PRODUCT_URLS = url_stats("Product URL", "url", "SELECT url AS u FROM catalog")
IMAGE_URLS = url_stats("Image URL", "images", f"SELECT images AS u FROM ({IMAGE_ITEMS})")
NO_IMAGE_URLS = ("SELECT 'Image URL' AS url_type, CAST(NULL AS VARCHAR) AS variable, CAST(NULL AS BIGINT) AS total_non_missing,"
                 " CAST(NULL AS BIGINT) AS valid_count, CAST(NULL AS BIGINT) AS invalid_count,"
                 " CAST(NULL AS BIGINT) AS duplicate_count")

PRICE_CHECKS = f"""
SELECT unnest(['Price: could not be parsed', 'Price: < 0', 'Price: == 0',
               'Discount: could not be parsed', 'Discount: < 0', 'Discount: > 100']) AS "check",
       unnest([{count_if('p IS NULL AND ' + present('price'))}, {count_if('p < 0')}, {count_if('p = 0')},
               {count_if('d IS NULL AND ' + present('discount'))}, {count_if('d < 0')}, {count_if('d > 100')}]) AS count
FROM (SELECT *, {num('price')} AS p, {num('discount')} AS d FROM catalog)"""

STAMP = ("COALESCE(TRY_STRPTIME(scraped_at, ['%Y-%m-%d %H:%M:%S', '%Y/%m/%d %H:%M']),"
         " TRY_STRPTIME(scraped_at, ['%m-%d-%Y %H:%M:%S', '%m/%d/%Y']),"
         " TRY_STRPTIME(scraped_at, ['%d-%m-%Y %H:%M:%S', '%d/%m/%Y']))")
STAMP_TEXT = "strftime({c}, '%Y-%m-%d %H:%M:%S')"
DATES = f"""
SELECT 'scraped_at' AS variable, {count_if(present('scraped_at'))} AS total_non_missing, count(t) AS parsed_count,
  {count_if(present('scraped_at') + ' AND t IS NULL')} AS unparsed_count,
  {STAMP_TEXT.format(c='min(t)')} AS earliest_date, {STAMP_TEXT.format(c='max(t)')} AS latest_date
FROM (SELECT scraped_at, {STAMP} AS t FROM catalog)"""

_FLAGS = {
    "price_missing_or_invalid": f"{num('price')} IS NULL",
    "price_negative": f"COALESCE({num('price')} < 0, false)",
    "discount_over_100": f"COALESCE({num('discount')} > 100, false)",
    "discount_negative": f"COALESCE({num('discount')} < 0, false)",
    "product_url_invalid": f"COALESCE(NOT regexp_matches(url, '^https?://') AND {present('url')}, false)",
}
_IMAGE_FLAG = {"image_url_invalid": f"COALESCE(NOT regexp_matches(images, '^https?://') AND {present('images')}, false)"}


def flags(which: dict[str, str]) -> str:
    total = " + ".join(f"CAST({f} AS INTEGER)" for f in which)
    listed = ", ".join(f"{sql} AS {name}" for name, sql in which.items())
    return f"SELECT row_number, {', '.join(which)}, CAST({total} AS INTEGER) AS issue_count FROM (SELECT *, {listed} FROM catalog)"


def problems(n: int | None = None) -> str:
    return f"""
SELECT {', '.join('c.' + c for c in ALL)} FROM catalog c JOIN ({flags(_FLAGS)}) f USING (row_number)
WHERE f.issue_count > 0{first(n)}"""

# ---------------------------------------------------------------- attributes

KV = r"''([^'']+)''\s*:\s*''([^'']*)''"
PAIRS = f"""
SELECT row_number, {squish('n')} AS attribute_name, {squish('v')} AS attribute_value
FROM (SELECT row_number, unnest(regexp_extract_all(description, '{KV}', 1)) AS n,
             unnest(regexp_extract_all(description, '{KV}', 2)) AS v FROM catalog WHERE {present('description')})"""


def attr(*keys: str) -> str:
    listed = ", ".join(keys)
    where = " AND ".join(present(k) for k in keys)
    return f"SELECT {listed}, count(*) AS count FROM ({PAIRS}) WHERE {where} GROUP BY {listed}"


def levels(table: str, columns: list[str], n: int | None = None) -> str:
    parts = [f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS value, count(*) AS count FROM {table}"
             f" WHERE {present(c)} GROUP BY 2" for c in columns]
    if n is None:
        return union(parts)
    return f"""SELECT variable, value, count FROM ({union(parts)})
QUALIFY row_number() OVER (PARTITION BY variable ORDER BY count DESC, value) <= {n}"""


# ---------------------------------------------------------------- cleaning

SKU = f"regexp_replace(regexp_replace(sku, '^SKU:\\s*', ''), '^{WS}+|{WS}+$', '', 'g')"


def deduplicated(coded: bool) -> str:
    keep = "rn = 1" if coded else "(rn = 1 OR sku IS NULL OR sku = '')"
    return f"""SELECT {', '.join(ALL)} FROM (
  SELECT *, row_number() OVER (PARTITION BY sku ORDER BY row_number) AS rn
  FROM (SELECT * REPLACE ({SKU} AS sku) FROM catalog)) WHERE {keep}"""


def price(coded: bool) -> str:
    if coded:
        return "TRY_CAST(regexp_replace(price, '[^0-9.]', '', 'g') AS DOUBLE)"
    minus = r"regexp_matches(price, '^\s*-\s*[^0-9.,()\-]{1,4}\s*[0-9.]')"
    brackets = r"regexp_matches(price, '^\s*\(\s*[^0-9.,()\-]{0,4}\s*[0-9.,]+\s*\)\s*$')"
    return f"(CASE WHEN {minus} OR {brackets} THEN -abs({num('price')}) ELSE {num('price')} END)"


def price_flag(p: str) -> str:
    return (f"CASE WHEN {p} IS NULL THEN 'missing' WHEN {p} <= 0 THEN 'invalid' WHEN {p} > 10000 THEN 'outlier_high'"
            " ELSE 'ok' END")


BRAND = f"nullif(regexp_replace(regexp_extract(strip_accents(brand), '^[^?�]+'), '^{WS}+|{WS}+$', '', 'g'), '')"
COLOR = r"nullif(regexp_extract(description, '''Color'':\s*''([^'']+)', 1), '')"
COLOR_ONE_SPACE = r"nullif(regexp_extract(description, '''Color'':\s''([^'']+)', 1), '')"
SIZE = (f"regexp_replace(regexp_replace({squish('size')}, '{WS}*\\(', '(', 'g'), '{WS}*,{WS}*', ',', 'g')")

_RULES = [
    ("z = 'one-size'", "one_size"), ("z = '' OR z IS NULL", "missing"),
    (r"regexp_matches(z, '\d+\*\d+')", "dimensions"), (r"regexp_matches(z, 'CN\d+')", "shoe_intl"),
    (r"regexp_matches(z, 'EUR\d+') AND NOT regexp_matches(z, '\bXS\b|\bS\b|\bM\b')", "shoe_intl"),
    (r"regexp_matches(z, '^US\d+\.?\d*(,|$)')", "shoe_us"),
    (r"regexp_matches(z, '\d{2}[A-H]{1,2}\(\d{2}[A-H]{1,2}\)')", "bra"),
    (r"regexp_matches(z, '\dY[,(]|\d{2}Y[,(]|IN\)')", "kids"), (r"regexp_matches(z, 'W\d+ L\d+')", "jeans"),
    (r"regexp_matches(z, '(?i)\d+\s*(ml|m,|m$| m,| m$)|\d+\s*inch')", "volume_length"),
    ("regexp_matches(z, '[0-6]XL')", "plus"), (r"regexp_matches(z, '[A-Z]+\(\d')", "us_clothing"),
    (r"regexp_matches(z, '^\d+\s*\([A-Z]')", "us_clothing"), (r"regexp_matches(z, '[A-Z]+\(\d{2}\)')", "eu_clothing"),
    (r"regexp_matches(z, '\b(XXS|XS|S|M|L|XL|XXL)\b')", "standard"), (r"regexp_matches(z, '^\d')", "us_letter"),
]
SYSTEM = "CASE " + " ".join(f"WHEN {c} THEN '{s}'" for c, s in _RULES) + " ELSE 'unknown' END"


def collected(*cases: tuple[str, str | None]) -> str:
    whens = []
    for systems, pattern in cases:
        value = "z" if pattern is None else f"array_to_string(regexp_extract_all(z, '{pattern}', 1), ', ')"
        whens.append(f"WHEN size_system IN ({systems}) THEN {value}")
    return "CASE " + " ".join(whens) + " END"


SIZE_COLUMNS = {
    "size_count": "CASE WHEN size_system = 'one_size' THEN 1 WHEN size_system IN ('missing', 'dimensions', 'volume_length')"
                  " THEN NULL WHEN contains(z, '-') AND NOT contains(z, '*') THEN NULL"
                  " ELSE CAST(len(string_split(z, ',')) AS INTEGER) END",
    "size_labels": collected(("'us_clothing', 'eu_clothing'", r"([A-Z]+)\("), ("'standard', 'shoe_us'", None),
                             ("'plus'", "([0-9]+XL)"), ("'kids'", r"(\d+Y)"), ("'us_letter'", r"\(([A-Za-z/ ]+)\)")),
    "size_us": collected(("'us_clothing'", r"\(([0-9/]+)\)"), ("'plus'", r"\(([0-9]+)\)"),
                         ("'shoe_intl'", "US([0-9.]+)"), ("'us_letter'", r"(\d+)\(")),
    "size_eu": collected(("'shoe_intl'", "(?:EUR|CN)([0-9]+)"), ("'eu_clothing'", r"\(([0-9]+)\)")),
    "dimensions_raw": collected(("'dimensions'", None)),
    "waist": r"CASE WHEN size_system = 'jeans' THEN nullif(regexp_extract(z, 'W(\d+)', 1), '') END",
    "inseam": r"CASE WHEN size_system = 'jeans' THEN nullif(regexp_extract(z, 'L(\d+)', 1), '') END",
    "has_petite": "contains(z, 'Petite')", "has_tall": r"regexp_matches(z, '\bTall\b')",
    "has_plus": "regexp_matches(z, '[0-6]XL')",
}


def sized(table: str) -> str:
    return f"SELECT *, {SYSTEM} AS size_system FROM (SELECT *, {SIZE} AS z FROM {table})"


def images(coded: bool) -> dict[str, str]:
    scheme = "https" if coded else "https?"
    urls = f"regexp_extract_all(images, '({scheme}://[^''\"\\]]+)', 1)"
    unique = f"list_filter({urls}, lambda x, i: list_position({urls}, x) = i)"
    joined = f"array_to_string({unique}, ' | ')"
    if coded:
        return {"images_clean": f"CASE WHEN images IS NULL THEN 'NA' ELSE {joined} END",
                "images_n": f"CAST(COALESCE(greatest(len({unique}), 1), 1) AS INTEGER)"}
    return {"images_clean": joined, "images_n": f"CAST(len({unique}) AS INTEGER)"}


def cleaned(coded: bool = False, color: str = COLOR, raw_images: bool = False) -> str:
    own = {
        "sku": "sku", "url": "url", "name": "name", "price": "p", "price_flag": price_flag("p"), "brand": BRAND,
        "color": color, "size_system": "size_system", **SIZE_COLUMNS,
        **({"images": "images"} if raw_images else images(coded)),
        "row_number": "row_number", "discount": "discount", "scraped_at": "scraped_at"}
    return (f"SELECT {', '.join(f'{sql} AS {name}' for name, sql in own.items())}"
            f" FROM (SELECT *, {price(coded)} AS p FROM ({sized('(' + deduplicated(coded) + ')')}))")


CLEANED_COLUMNS = [*PRIORITY, "row_number", "discount", "scraped_at"]


def run_counters(coded: bool) -> str:
    return f"""
SELECT unnest(['rows_before_dedup', 'rows_after_dedup', 'duplicate_rows_removed', 'price_issues', 'brands_set_null',
               'color_found', 'color_missing']) AS counter,
       unnest([b, a, b - a, pi, bn, cf, a - cf]) AS value
FROM (SELECT (SELECT count(*) FROM catalog) AS b, count(*) AS a, {count_if("price_flag <> 'ok'")} AS pi,
      {count_if('brand IS NULL')} AS bn, count(color) AS cf FROM ({cleaned(coded)}))"""


# ---------------------------------------------------------------- report


def facts(coded: bool = False) -> str:
    columns = ALL if coded else DATA
    any_gap = " OR ".join(miss(c) for c in columns)
    high = " + ".join(f"CAST({pct(count_if(miss(c)), 'count(*)')} >= 30 AS BIGINT)" for c in columns)
    quality = text_quality("catalog", DATA, not coded)
    bad_urls = f"(SELECT CAST(sum(invalid_count) AS BIGINT) FROM ({PRODUCT_URLS if coded else union([PRODUCT_URLS, IMAGE_URLS])}))"
    parse = " + ".join(
        count_if(f"{c} IS NOT NULL AND {c} NOT IN {WORDS} AND {num(c)} IS NULL") for c in ("price", "discount"))
    checks = {"price_unparsed": "Price: could not be parsed", "price_negative": "Price: < 0", "price_zero": "Price: == 0",
              "discount_unparsed": "Discount: could not be parsed", "discount_over_100": "Discount: > 100",
              "discount_negative": "Discount: < 0"}
    values = {
        "rows": "(SELECT count(*) FROM catalog)", "columns": str(len(columns)),
        "exact_duplicates": "0" if coded else EXACT_COPIES,
        "rows_missing": f"(SELECT {count_if(any_gap)} FROM catalog)",
        "duplicate_urls": key_copies("catalog", "url"), "duplicate_names": key_copies("catalog", "name"),
        **{f: f"""(SELECT count FROM ({PRICE_CHECKS}) WHERE "check" = '{label}')""" for f, label in checks.items()},
        "url_issues": bad_urls,
        "timestamps_unparsed": f"(SELECT unparsed_count FROM ({DATES}))", "timestamp_columns": "1",
        "edge_space": f"(SELECT CAST(sum(leading_trailing_space_count) AS BIGINT) FROM ({quality}))",
        "line_breaks": f"(SELECT CAST(sum(newline_count) AS BIGINT) FROM ({quality}))",
        "high_missing_columns": f"(SELECT {high} FROM catalog)", "parse_failures": f"(SELECT {parse} FROM catalog)",
        "image_duplicates": "0" if coded else f"(SELECT {count_if(REPEATS)} FROM catalog)"}
    return union([f"SELECT '{f}' AS fact, CAST({sql} AS BIGINT) AS value" for f, sql in values.items()])


def executive(coded: bool) -> str:
    def f(name: str) -> str:
        return f"max(value) FILTER (WHERE fact = '{name}')"

    shown = "printf('%.1f%%', CAST({n} AS DOUBLE) * 100 / {d})"
    return f"""
SELECT {f('rows')} AS total_rows, {len(DATA)}::BIGINT AS total_columns, {f('exact_duplicates')} AS exact_duplicates,
  {shown.format(n=f('exact_duplicates'), d=f('rows'))} AS exact_duplicates_pct, {f('rows_missing')} AS rows_missing,
  {shown.format(n=f('rows_missing'), d=f('rows'))} AS rows_missing_pct,
  {f('price_unparsed')} + {f('price_negative')} + {f('price_zero')} AS price_anomalies,
  {f('image_duplicates')} AS image_dup_records, {pct(f('image_duplicates'), f('rows'), 1)} AS image_dup_pct
FROM ({facts(coded)})"""


# The rows of the issue register.
REGISTER = [
    ('S1', 'Structure', 'Exact duplicate rows', 'exact_duplicates', 'High', 'Drop exact copies, keep the first row'),
    ('S2', 'Missingness', '{n} column(s) exceed 30% missing', 'high_missing_columns', 'Medium', 'Decide per column: impute, exclude or document'),
    ('D1', 'Duplicates', 'Duplicate product URLs — multi-date scraping', 'duplicate_urls', 'High', 'Keep the latest scrape per product URL'),
    ('D2', 'Duplicates', 'Duplicate product names', 'duplicate_names', 'Medium', 'Tell real variants from scraping copies'),
    ('D3', 'Duplicates', 'Duplicate image URLs within product rows', 'image_duplicates', 'Medium', 'Keep each image URL once per row'),
    ('P1', 'Price', 'Price values that could not be parsed', 'price_unparsed', 'High', 'Strip marks and parse; NULL when hopeless'),
    ('P2', 'Price', 'Prices equal to zero', 'price_zero', 'Medium', 'Settle: free item or missing price'),
    ('P3', 'Price', 'Prices that are negative', 'price_negative', 'High', 'Set NULL and report to the source'),
    ('P4', 'Discount', 'Discounts exceeding 100%', 'discount_over_100', 'High', 'Cap at 100 and flag'),
    ('U1', 'URLs', 'URLs not starting with http(s)://', 'url_issues', 'Medium', 'Repair the prefix, else drop'),
    ('T1', 'Text', 'Leading / trailing whitespace', 'edge_space', 'Low', 'Squish every text column'),
    ('T2', 'Text', 'Embedded newline characters', 'line_breaks', 'Low', 'Turn line breaks into blanks'),
    ('DT1', 'Timestamps', 'Timestamp parsing failures', 'timestamps_unparsed', 'Medium', 'Add date orders'),
    ('I1', 'Images', 'Multi-date scrape without deduplication', 'image_duplicates', 'High', 'Treat the latest scrape per URL as the product'),
]


def register(coded: bool) -> str:
    rows = ", ".join("(" + ", ".join(f"'{quoted(v)}'" for v in row) + ")" for row in REGISTER)
    return f"""
SELECT id, category, replace(description, '{{n}}', CAST(value AS VARCHAR)) AS description, value AS affected, priority, action
FROM (VALUES {rows}) r(id, category, description, fact, priority, action) JOIN ({facts(coded)}) USING (fact)"""


ALERTS = f"""
WITH f AS MATERIALIZED ({facts()}),
more AS (SELECT * FROM f
  UNION ALL SELECT 'price_discount_issues', CAST(sum(value) AS BIGINT) FROM f WHERE fact LIKE 'price_%' OR fact LIKE 'discount_%'
  UNION ALL SELECT 'timestamps_state', CAST(value = 0 AS BIGINT) FROM f WHERE fact = 'timestamps_unparsed')
SELECT rule, CASE WHEN value > 0 THEN positive ELSE zero END AS severity, value AS affected
FROM (VALUES ('exact_duplicates', 'exact_duplicates', 'high', NULL), ('duplicate_urls', 'duplicate_urls', 'high', NULL),
 ('image_duplicates', 'image_duplicates', 'medium', 'medium'), ('high_missing_columns', 'high_missing_columns', 'medium', 'low'),
 ('parse_failures', 'parse_failures', 'medium', 'low'), ('price_unparsed', 'price_unparsed', 'high', NULL),
 ('price_negative', 'price_negative', 'high', NULL), ('price_zero', 'price_zero', 'high', NULL),
 ('discount_unparsed', 'discount_unparsed', 'high', NULL), ('discount_over_100', 'discount_over_100', 'high', NULL),
 ('discount_negative', 'discount_negative', 'high', NULL), ('no_price_or_discount_issue', 'price_discount_issues', NULL, 'low'),
 ('url_issues', 'url_issues', 'medium', 'low'), ('timestamps_unparsed', 'timestamps_unparsed', 'medium', NULL),
 ('all_timestamps_parsed', 'timestamps_state', 'info', NULL), ('no_timestamp_column', 'timestamp_columns', NULL, 'medium'),
 ('edge_space', 'edge_space', 'low', NULL), ('line_breaks', 'line_breaks', 'low', NULL)) r(rule, fact, positive, zero)
JOIN more USING (fact) WHERE CASE WHEN value > 0 THEN positive ELSE zero END IS NOT NULL"""


def coverage(rows: list[tuple[str, str | None]]) -> str:
    return union([f"SELECT '{field}' AS expected_field, " + (
        f"'{c}' AS detected_column, (SELECT count(*) FROM catalog WHERE {present(c)}) AS present_rows" if c else
        "CAST(NULL AS VARCHAR) AS detected_column, CAST(NULL AS BIGINT) AS present_rows") for field, c in rows])


STRICT_ROLES = [("product", "name"), ("price", "price"), ("discount", "discount"), ("color", None), ("size", "size"),
                ("category", None), ("material", None), ("product_url", "url"), ("image_url", None),
                ("scraped_at", "scraped_at")]
LOOSE_ROLES = [(r, "images" if r == "image_url" else c) for r, c in STRICT_ROLES]


# The log of the cleaner.
DROP_LOG = [
    ("price", "replaced", "text without currency marks, as a number; price_flag tells missing, invalid and very high prices apart"),
    ("description", "dropped", "serialised attributes; only the colour is kept, as column color, the others are too sparse"),
    ("size", "replaced", "mixes several size systems; replaced by size_system, size_labels, size_us, size_eu, dimensions_raw, waist, inseam,"
                         " size_count and has_petite, has_tall, has_plus, empty where they do not apply"),
    ("images", "replaced", "serialised list; replaced by images_clean (distinct URLs) and images_n (their number)"),
]


def drop_log() -> str:
    return union([f"""SELECT '{column}' AS "column", '{action}' AS action, '{quoted(reason)}' AS reason,
        (SELECT count(*) FROM catalog WHERE {present(column)}) AS present_rows""" for column, action, reason in DROP_LOG])


IMPUTED = f"""
WITH c AS MATERIALIZED ({cleaned()}),
med AS (SELECT size_system, quantile_cont(price, 0.5) AS m FROM c WHERE price IS NOT NULL GROUP BY 1),
b AS (SELECT size_system, brand AS m FROM c WHERE {present('brand')} GROUP BY 1, 2
      QUALIFY row_number() OVER (PARTITION BY size_system ORDER BY count(*) DESC, brand) = 1),
k AS (SELECT size_system, color AS m FROM c WHERE {present('color')} GROUP BY 1, 2
      QUALIFY row_number() OVER (PARTITION BY size_system ORDER BY count(*) DESC, color) = 1)
SELECT c.row_number, c.size_system, round(coalesce(c.price, med.m), 6) AS price, c.price IS NULL AND med.m IS NOT NULL AS price_imputed,
  coalesce(c.brand, b.m) AS brand, c.brand IS NULL AND b.m IS NOT NULL AS brand_imputed,
  coalesce(c.color, k.m) AS color, c.color IS NULL AND k.m IS NOT NULL AS color_imputed
FROM c LEFT JOIN med USING (size_system) LEFT JOIN b USING (size_system) LEFT JOIN k USING (size_system)"""


def _levels(best: str) -> str:
    """A fill for each level of groups; ``best`` picks it from a group, as ``m``."""
    parts = []
    for i, by in enumerate(("size_system, brand", "size_system", "")):
        group = f"GROUP BY {by}" if by else ""
        parts.append(best.format(i=i, by=by + ", " if by else "", group=group, over=f"PARTITION BY {by}" if by else ""))
    return ",\n".join(parts)


IMPUTED_LEVELS = f"""
WITH c AS MATERIALIZED ({cleaned()}),
{_levels("p{i} AS (SELECT {by} quantile_cont(price, 0.5) AS m FROM c WHERE price IS NOT NULL {group})")},
{_levels("k{i} AS (SELECT {by} color AS m FROM c WHERE color IS NOT NULL AND color <> '' GROUP BY {by} color QUALIFY row_number() OVER ({over} ORDER BY count(*) DESC, color) = 1)")}
SELECT c.row_number, round(coalesce(c.price, p0.m, p1.m, p2.m), 6) AS price, c.price IS NULL AND coalesce(p0.m, p1.m, p2.m) IS NOT NULL AS price_imputed,
  CASE WHEN c.price IS NULL THEN CASE WHEN p0.m IS NOT NULL THEN 'size_system brand' WHEN p1.m IS NOT NULL THEN 'size_system' WHEN p2.m IS NOT NULL THEN 'all' END END AS price_imputed_from,
  CASE WHEN c.color <> '' THEN c.color ELSE coalesce(k0.m, k1.m, k2.m, c.color) END AS color,
  CASE WHEN c.color IS NULL OR c.color = '' THEN CASE WHEN k0.m IS NOT NULL THEN 'size_system brand' WHEN k1.m IS NOT NULL THEN 'size_system' WHEN k2.m IS NOT NULL THEN 'all' END END AS color_imputed_from
FROM c LEFT JOIN p0 ON c.size_system IS NOT DISTINCT FROM p0.size_system AND c.brand IS NOT DISTINCT FROM p0.brand
LEFT JOIN p1 ON c.size_system IS NOT DISTINCT FROM p1.size_system LEFT JOIN p2 ON TRUE
LEFT JOIN k0 ON c.size_system IS NOT DISTINCT FROM k0.size_system AND c.brand IS NOT DISTINCT FROM k0.brand
LEFT JOIN k1 ON c.size_system IS NOT DISTINCT FROM k1.size_system LEFT JOIN k2 ON TRUE"""


PREPARED = ["sku", "url", "name", "discount", "brand", "description", "size", "scraped_at", "price", "price_flag", "discount_flag",
            "images_clean", "images_n"]


def prepared() -> str:
    own = {c: squish(c) for c in ("sku", "name", "brand", "description", "size", "scraped_at")}
    own |= {"row_number": "row_number", "price": "p", "price_flag": price_flag("p"), "images_clean": images(False)["images_clean"],
            "images_n": images(False)["images_n"], "discount": "CASE WHEN d IS NOT NULL THEN least(d, 100.0) END",
            "discount_flag": f"CASE WHEN {miss('discount')} THEN 'missing' WHEN d IS NULL THEN 'unparsed' WHEN d > 100 OR d < 0 THEN 'invalid' ELSE 'ok' END",
            "url": squish("CASE WHEN regexp_matches(url, '^https?://') THEN url WHEN regexp_matches(url, '^www\\.') THEN 'https://' || url END")}
    listed = ", ".join(f"{sql} AS {name}" for name, sql in own.items())
    return f"""SELECT {listed} FROM (SELECT *, {price(False)} AS p, {num('discount')} AS d FROM (
  SELECT *, row_number() OVER (PARTITION BY CASE WHEN {present('url')} THEN 'key:' || url ELSE 'row:' || CAST(row_number AS VARCHAR) END
    ORDER BY {STAMP} DESC NULLS LAST, row_number) AS rn
  FROM (SELECT min(row_number) AS row_number, {', '.join(DATA)} FROM catalog GROUP BY {', '.join(DATA)})) WHERE rn = 1)"""


def column_summary(table: str, columns: dict[str, str], numeric: set[str]) -> str:
    parts = []
    for c, t in columns.items():
        stats = ", ".join(
            f"round({sql.format(c=f'CAST({c} AS DOUBLE)')}, 6) AS {name}" if c in numeric else f"CAST(NULL AS DOUBLE) AS {name}"
            for name, sql in (("min", "min({c})"), ("q1", "quantile_cont({c}, 0.25)"), ("median", "quantile_cont({c}, 0.5)"),
                              ("mean", "favg({c}) * (1 + 1e-12::DOUBLE)"), ("q3", "quantile_cont({c}, 0.75)"), ("max", "max({c})")))
        parts.append(f"SELECT '{c}' AS variable, '{t}' AS type, count(*) AS length, {count_if(c + ' IS NULL')} AS nulls, {stats} FROM {table}")
    return union(parts)


ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz",
               "o_orderpriority": "string"}
LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
              "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
              "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}


CSV_NOTE = "CASE WHEN o_orderkey % 3 <> 0 THEN 'say \"hi\", ' || o_orderpriority || chr(10) || 'line ' || o_orderstatus END"

# The catalogue's texts are year first, month first with a day above 12, day first with a day above 12, or no date.
DATE_VOTES = """SELECT date_order, parsed, parsed AS only_parsed FROM (
  SELECT 'ymd' AS date_order, count(*) FILTER (regexp_matches(scraped_at, '^[0-9]{4}[-/]')) AS parsed FROM catalog
  UNION ALL SELECT 'mdy', count(*) FILTER (regexp_matches(scraped_at, '^01/25/')) FROM catalog
  UNION ALL SELECT 'dmy', count(*) FILTER (regexp_matches(scraped_at, '^25-01-')) FROM catalog)"""

#: The tables of the bundle by the names of their queries.
BUNDLE = ("overview detected_columns variable_types missingness_by_variable missingness_by_row duplicate_summary exact_dup_rows dup_url_rows"
          " image_dup_summary range_checks numeric_parse_issues price_discount_checks url_checks datetime_checks text_quality level_summary"
          " attr_names attr_values attr_name_values problem_rows").split()


def bundled(found: dict[str, str]) -> dict[str, str]:
    """Queries on the bundle, from those of its tables."""
    return {"bundle_counts": union([f"SELECT '{n}' AS name, count(*) AS records FROM ({found[n]})" for n in BUNDLE]),
            **{f"bundle_{n}": found[n] for n in ("overview", "text_quality", "url_checks")}}


def oracle_sql() -> dict[str, str]:
    dup_rows = f"""SELECT {', '.join(ALL)} FROM (SELECT *, count(*) OVER (PARTITION BY url) AS n FROM catalog
        WHERE {present('url')}) WHERE n > 1"""
    types = {c: "string" for c in DATA}
    high = f"SELECT * FROM ({missingness('catalog', DATA)}) WHERE missing_pct >= 30"
    doc_copies = union([f"SELECT '{c}' AS variable, count({c}) AS present, count({c}) - count(DISTINCT {c}) AS copies"
                        f" FROM documents WHERE {present(c)}" for c in ("text", "lang", "source")])
    found = {
        "overview": on_catalog(overview("catalog", DATA)),
        "overview_as_coded": on_catalog(overview("catalog", ALL)),
        "detected_columns": on_catalog(coverage(STRICT_ROLES)),
        "detected_columns_loose": on_catalog(coverage(LOOSE_ROLES)),
        "variable_types": on_catalog(variable_types("catalog", types)),
        "variable_types_as_coded": on_catalog(variable_types("catalog", {"row_number": "bigint", **types})),
        "missingness_by_variable": on_catalog(missingness("catalog", DATA)),
        "missingness_by_variable_as_coded": on_catalog(missingness("catalog", ALL)),
        "high_missing_columns": on_catalog(high),
        "missingness_by_row": on_catalog(missing_by_row("catalog", DATA)),
        "duplicate_summary": on_catalog(duplicate_summary(EXACT_COPIES)),
        "duplicate_summary_as_coded": on_catalog(duplicate_summary("CAST(0 AS BIGINT)")),
        "exact_dup_rows": on_catalog(exact_rows()),
        "exact_dup_rows_top50": on_catalog(exact_rows(50)),
        "dup_url_rows": on_catalog(dup_rows),
        "dup_url_rows_top50": on_catalog(dup_rows + first(50)),
        "image_dup_summary": on_catalog(f"""
SELECT 'Records with at least one duplicate image URL' AS metric, CAST({count_if(REPEATS)} AS VARCHAR) AS value FROM catalog
UNION ALL SELECT 'Pct of total records', regexp_replace(CAST({pct(count_if(REPEATS), 'count(*)')} AS VARCHAR), '\\.0$', '') || '%'
FROM catalog"""),
        "image_dup_rows": on_catalog(f"SELECT row_number, images FROM catalog WHERE {REPEATS}"),
        "image_url_counts": on_catalog(f"SELECT images, count(*) AS count FROM ({IMAGE_ITEMS}) WHERE {present('images')} GROUP BY 1"),
        "range_checks": on_catalog(ranges("catalog", PRICE_RANGES)),
        "range_checks_as_coded": on_catalog(ranges("catalog", {**native("row_number", shown="bigint"), **PRICE_RANGES})),
        "numeric_parse_issues": on_catalog(union([
            f"""SELECT '{c}' AS variable, row_number, {c} AS original_value, 'Value could not be parsed as a number' AS issue
            FROM catalog WHERE {c} IS NOT NULL AND {c} NOT IN {WORDS} AND {num(c)} IS NULL""" for c in ("price", "discount")])),
        "price_discount_checks": on_catalog(PRICE_CHECKS),
        "url_checks": on_catalog(union([PRODUCT_URLS, IMAGE_URLS])),
        "url_checks_as_coded": on_catalog(union([PRODUCT_URLS, NO_IMAGE_URLS])),
        "url_checks_loose": on_catalog(union([PRODUCT_URLS, url_stats("Image URL", "images", "SELECT images AS u FROM catalog")])),
        "datetime_checks": on_catalog(DATES),
        "text_quality": on_catalog(text_quality("catalog", DATA)),
        "text_quality_as_coded": on_catalog(text_quality("catalog", DATA, raw_space=False)),
        "text_issue_columns": on_catalog(f"""
SELECT variable, blank_count, leading_trailing_space_count, multiple_space_count, newline_count, max_text_length
FROM ({text_quality('catalog', DATA)}) WHERE blank_count + leading_trailing_space_count + multiple_space_count + newline_count > 0"""),
        "level_summary": on_catalog(levels("catalog", ["size"])),
        "level_summary_top50": on_catalog(levels("catalog", ["size", "description"], 50)),
        "attribute_pairs": on_catalog(PAIRS),
        "attr_names": on_catalog(attr("attribute_name")),
        "attr_values": on_catalog(attr("attribute_value")),
        "attr_name_values": on_catalog(attr("attribute_name", "attribute_value")),
        "issue_flags": on_catalog(flags(_FLAGS)),
        "issue_flags_loose": on_catalog(flags({**_FLAGS, **_IMAGE_FLAG})),
        "problem_rows": on_catalog(problems()),
        "problem_rows_top100": on_catalog(problems(100)),
        "issue_register": on_catalog(register(False)),
        "issue_register_as_coded": on_catalog(register(True)),
        "executive_metrics": on_catalog(executive(False)),
        "executive_metrics_as_coded": on_catalog(executive(True)),
        "alerts": on_catalog("SELECT * FROM a", a=ALERTS),
        "report_facts": on_catalog(facts()),
        "preview_head": on_catalog(f"SELECT {', '.join(ALL)} FROM catalog ORDER BY row_number LIMIT 3"),
        "column_summary_lineitem": column_summary("lineitem", LINE_TYPES, set(LINE_NUMBERS)),
        "sample_extract": on_catalog("SELECT row_number, " + ", ".join(f"{sane(c)} AS {c}" for c in DATA) + " FROM catalog"),
        "sample_extract_top1000": on_catalog("SELECT row_number, " + ", ".join(f"{sane(c)} AS {c}" for c in DATA) + " FROM catalog" + first(1000)),
        "row_identity_orders": "SELECT row_number() OVER (ORDER BY o_orderkey) AS row_number, o_orderkey FROM orders",
        "sku_dedup": on_catalog(deduplicated(False)),
        "sku_dedup_as_coded": on_catalog(deduplicated(True)),
        "sku_dedup_blank": on_catalog(f"""SELECT {', '.join(ALL)} FROM (
  SELECT *, row_number() OVER (PARTITION BY sku ORDER BY row_number) AS rn FROM (SELECT * REPLACE ({SKU} AS sku) FROM (
    SELECT * REPLACE (CASE WHEN row_number % 11 = 0 THEN '' WHEN row_number % 13 = 0 THEN 'SKU: ' ELSE sku END AS sku) FROM catalog)))
WHERE rn = 1 OR sku IS NULL OR sku = ''"""),
        "price_clean": on_catalog(f"SELECT row_number, {price(False)} AS price, {price_flag(price(False))} AS price_flag FROM catalog"),
        "price_clean_as_coded": on_catalog(
            f"SELECT row_number, {price(True)} AS price, {price_flag(price(True))} AS price_flag FROM catalog"),
        "brand_clean": on_catalog(f"SELECT row_number, {BRAND} AS brand FROM catalog"),
        "color_extract": on_catalog(f"SELECT row_number, {COLOR} AS color FROM catalog"),
        "color_extract_one_space": on_catalog(f"SELECT row_number, {COLOR_ONE_SPACE} AS color FROM catalog"),
        "size_normalise": on_catalog(f"SELECT row_number, {SIZE} AS size FROM catalog"),
        "size_system": on_catalog(f"SELECT row_number, z AS size, size_system FROM ({sized('catalog')})"),
        "size_columns": on_catalog("SELECT row_number, size_system, " + ", ".join(f"{s} AS {n}" for n, s in SIZE_COLUMNS.items())
                                   + f" FROM ({sized('catalog')})"),
        "images_clean": on_catalog("SELECT row_number, " + ", ".join(f"{s} AS {n}" for n, s in images(False).items()) + " FROM catalog"),
        "images_clean_as_coded": on_catalog(
            "SELECT row_number, " + ", ".join(f"{s} AS {n}" for n, s in images(True).items()) + " FROM catalog"),
        "cleaned_table": on_catalog(cleaned()),
        "cleaned_table_as_coded": on_catalog(cleaned(True)),
        "cleaned_table_raw_images": on_catalog(cleaned(color=COLOR_ONE_SPACE, raw_images=True)),
        "clean_missing_summary": on_catalog(
            f"SELECT variable, missing_count FROM ({missingness('c', CLEANED_COLUMNS)})", c=cleaned()),
        "size_system_distribution": on_catalog("SELECT size_system, count(*) AS count FROM c GROUP BY 1", c=cleaned()),
        "price_flag_distribution": on_catalog("SELECT price_flag, count(*) AS count FROM c GROUP BY 1", c=cleaned()),
        "drop_log": on_catalog(drop_log()),
        "clean_run_counters": on_catalog(run_counters(False)),
        "clean_written_counters": on_catalog(run_counters(False)),
        "csv_landed_orders": f"SELECT o_orderkey, o_custkey, {CSV_NOTE} AS note, o_orderpriority, TRUE AS numbers FROM orders",
        "csv_clean_orders": f"SELECT o_orderkey, o_custkey, {CSV_NOTE} AS note, o_orderpriority FROM orders",
        "date_order_votes": on_catalog(DATE_VOTES),
        "elected_timestamps_orders": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' AS day FROM orders",
        "sketched_ranges_orders": """SELECT variable, count(v) AS parsed_count, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean,
  count(*) FILTER (v < 0) AS negative_count, count(*) FILTER (v = 0) AS zero_count, TRUE AS median_near
FROM (SELECT 'o_totalprice' AS variable, o_totalprice AS v FROM orders UNION ALL SELECT 'o_custkey', CAST(o_custkey AS DOUBLE) FROM orders) GROUP BY variable""",
        "sketched_distinct_orders": union([f"SELECT '{c}' AS variable, count({c}) AS present, count(DISTINCT {c}) AS exact, TRUE AS near FROM orders"
                                           for c in ("o_orderkey", "o_custkey", "o_orderpriority")]),
        "sketched_overlap_orders": """SELECT 'o_custkey' AS variable, count(*) FILTER (f) AS exact_one, count(*) FILTER (o) AS exact_other,
  count(*) FILTER (f AND o) AS exact_both, TRUE AS near
FROM (SELECT bool_or(o_orderstatus = 'F') AS f, bool_or(o_orderstatus = 'O') AS o FROM orders GROUP BY o_custkey)""",
        "clean_run_counters_as_coded": on_catalog(run_counters(True)),
        "missing_flags": on_catalog(f"""SELECT row_number, {miss('discount')} AS missing,
  discount IS NULL OR discount IN {WORDS} AS numeric_missing, COALESCE(regexp_matches(url, '^https?://'), false) AS web_url FROM catalog"""),
        "sanitised_names": on_catalog(f"SELECT row_number, {sane('name')} AS name FROM catalog"),
        "trimmed_names": on_catalog(f"SELECT row_number, regexp_replace(name, '^{WS}+|{WS}+$', '', 'g') AS name FROM catalog"),
        "folded_brands": on_catalog("SELECT row_number, strip_accents(brand) AS brand FROM catalog"),
        "parsed_numbers": on_catalog(f"SELECT row_number, {num('price')} AS price, {num('discount')} AS discount FROM catalog"),
        "parsed_timestamps": on_catalog(f"SELECT row_number, {STAMP_TEXT.format(c=STAMP)} AS scraped_at FROM catalog"),
        "image_list_elements": on_catalog(f"""
SELECT row_number, CAST(generate_subscripts({IMAGES}, 1) - 1 AS INTEGER) AS position, unnest({IMAGES}) AS element
FROM catalog WHERE images IS NOT NULL"""),
        "number_formats": on_catalog(f"""
SELECT size, format('{{:,}}', count(*) * 1000) AS n_text,
  printf('%.1f%%', CAST({count_if(present('price'))} AS DOUBLE) * 100 / (count(*) * 3)) AS present_text FROM catalog GROUP BY size"""),
        "latest_per_url": on_catalog(f"""SELECT {', '.join(ALL)} FROM (SELECT *, row_number() OVER (PARTITION BY url
  ORDER BY {STAMP} DESC NULLS LAST, row_number) AS rn FROM catalog WHERE {present('url')}) WHERE rn = 1"""),
        "image_scrape_dates": on_catalog(f"""SELECT DISTINCT row_number, replace(d, '/', '-') AS scrape_date
  FROM (SELECT row_number, regexp_extract(images, '/(\\d{{4}}/\\d{{2}}/\\d{{2}})/', 1) AS d FROM ({IMAGE_ITEMS})) WHERE d <> ''"""),
        "exact_dedup": on_catalog(f"SELECT min(row_number) AS row_number, {', '.join(DATA)} FROM catalog GROUP BY {', '.join(DATA)}"),
        "discount_cap": on_catalog(f"""SELECT row_number, CASE WHEN d IS NOT NULL THEN least(d, 100.0) END AS discount,
  CASE WHEN {miss('discount')} THEN 'missing' WHEN d IS NULL THEN 'unparsed' WHEN d > 100 OR d < 0 THEN 'invalid' ELSE 'ok' END AS discount_flag
  FROM (SELECT *, {num('discount')} AS d FROM catalog)"""),
        "url_repair": on_catalog("""SELECT row_number, CASE WHEN regexp_matches(url, '^https?://') THEN url
  WHEN regexp_matches(url, '^www\\.') THEN 'https://' || url END AS url FROM catalog"""),
        "squish_all": on_catalog("SELECT row_number, " + ", ".join(f"{squish(c)} AS {c}" for c in DATA) + " FROM catalog"),
        "imputation_plan": on_catalog(f"""SELECT variable, missing_pct, CASE WHEN missing_count = 0 THEN 'keep'
  WHEN missing_pct >= 30 THEN 'document' ELSE 'impute' END AS decision FROM ({missingness('catalog', DATA)})"""),
        "imputation_plan_exclude": on_catalog(f"""SELECT variable, missing_pct, CASE WHEN missing_count = 0 THEN 'keep' WHEN missing_pct >= 40 THEN 'exclude'
  WHEN missing_pct >= 30 THEN 'document' ELSE 'impute' END AS decision FROM ({missingness('catalog', DATA)})"""),
        "impute_by_levels": on_catalog("SELECT * FROM i", i=IMPUTED_LEVELS),
        "impute_by_size_system": on_catalog("SELECT * FROM i", i=IMPUTED),
        "post_clean_missingness": on_catalog(missingness("c", [c for c in CLEANED_COLUMNS if c != "row_number"]), c=cleaned()),
        "post_clean_ranges": on_catalog(ranges("c", {"price": ("double", "price"), "size_count": ("int", "size_count"),
                                                     "images_n": ("int", "images_n"),
                                                     "discount": PRICE_RANGES["discount"]}), c=cleaned()),
        "prepared_table": on_catalog("SELECT * FROM prepared", prepared=prepared()),
        "prepared_decisions": on_catalog(f"""SELECT variable, missing_pct, CASE WHEN missing_count = 0 THEN 'keep'
  WHEN missing_pct >= 30 THEN 'document' ELSE 'impute' END AS decision FROM ({missingness('prepared', PREPARED)})""", prepared=prepared()),
        "text_quality_documents": text_quality("documents", ["text", "lang", "source"]),
        "text_quality_pages": text_quality("pages", ["url", "html"]),
        "dup_documents": doc_copies,
        "dup_lineitem_rows": """SELECT key, l_orderkey, l_linenumber FROM (
  SELECT CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS key, l_orderkey, l_linenumber FROM lineitem)
QUALIFY count(*) OVER (PARTITION BY key) > 1""",
        "dup_document_rows": f"""SELECT doc_id, text, lang, source, n_chars FROM
  (SELECT *, count(*) OVER (PARTITION BY text) AS n FROM documents WHERE {present('text')}) WHERE n > 1""",
        "exact_dedup_documents": "SELECT min(doc_id) AS doc_id, text, lang, source, n_chars FROM documents GROUP BY 2, 3, 4, 5",
        "url_checks_pages": url_stats("Product URL", "url", "SELECT url AS u FROM pages"),
        "range_checks_lineitem": ranges("lineitem", {c: (LINE_TYPES[c], c) for c in LINE_NUMBERS}),
        "range_checks_orders": ranges("orders", {**native("o_orderkey", "o_custkey", shown="bigint"), **native("o_totalprice")}),
        "range_checks_events": ranges("events", {**native("event_id", "user_id", shown="bigint"), **native("value")}),
        "level_summary_customer": levels("customer", ["c_mktsegment", "c_nationkey"], 10),
        "level_summary_documents": levels("documents", ["lang", "source"]),
        "missingness_events": missingness("events", ["event_id", "ts", "user_id", "event_type", "value", "props"]),
        "missingness_by_row_events": missing_by_row("events", ["event_id", "ts", "user_id", "event_type", "value", "props"]),
        "inferred_types_orders": variable_types("orders", ORDER_TYPES),
        "variable_types_customer": variable_types("customer", {
            "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}),
        "overview_lineitem": overview("lineitem", list(LINE_TYPES)),
        "overview_conversations": overview("conversations", ["conv_id", "turn", "role", "text"]),
    }
    return found | bundled(found)

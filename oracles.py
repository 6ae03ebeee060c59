"""DuckDB twins of the registered queries.

Each twin derives the same messy records from the benchmark tables and cleans them with DuckDB's
own functions (`printf`, `strftime`, `try_strptime`, window functions), so that it shares no
expression with the Spark side. Aggregated doubles are rounded on both sides, because the order
of summation differs; values of single rows are compared as they are.
"""

AMENITIES = ("has_electricity", "has_drinking_water", "has_functional_toilet",
             "has_boundary_wall", "has_playground")


# Messy spellings -------------------------------------------------------------------------


def _id(k):
    return (f"CASE {k} % 5 WHEN 0 THEN printf('SCH%04d', {k}) WHEN 1 THEN printf('SCH-%04d', {k}) "
            f"WHEN 2 THEN printf(' sch_%04d', {k}) WHEN 3 THEN printf('S%d', {k}) ELSE printf('%d', {k}) END")


def _known_id(k, key):
    return f"CASE WHEN {key} % 53 = 11 THEN NULL WHEN {key} % 59 = 13 THEN ' unlisted ' ELSE {_id(k)} END"


def _date(d, k):
    formats = ["%Y-%m-%d", "%Y/%m/%d", "%d-%b-%Y", "%d-%m-%Y", "%m-%d-%Y", "%d.%m.%Y"]
    whens = " ".join(f"WHEN {n} THEN strftime({d}, '{f}')" for n, f in enumerate(formats))
    return f"CASE {k} % 8 {whens} WHEN 6 THEN 'n/k' END"


def _rare_date(d, k):
    formats = {2: "%d-%b-%y", 3: "%m.%d.%Y", 4: "%d/%m/%Y", 5: "%Y%m%d", 6: "%b %d, %Y", 7: "%d %b %Y",
               8: "%Y-%m-%d 08:30:00", 9: "%m/%d/%y"}
    whens = " ".join(f"WHEN {n} THEN strftime({d}, '{f}')" for n, f in formats.items())
    return (f"CASE {k} % 12 WHEN 0 THEN strftime({d}, '%Y') || '-02-31' WHEN 1 THEN '31-02-' || strftime({d}, '%Y') "
            f"{whens} WHEN 10 THEN '30.02.' || strftime({d}, '%Y') ELSE '  ' END")


def _fallback_date(d, k):
    layouts = ("%m-%d-%Y 08:30:00", "%m/%d/%Y 14:30", "%d/%b/%Y", "%d.%B.%Y", "%Y.%m.%d", "%Y-%b-%d", "%m.%d.%y",
               "%d-%b-%Y 08:30", "%d %B %Y 09:00", "%A, %d %B %Y", "%d-%B-%y", "%b %-d, %Y", "%Y%m%dT083000",
               "%b %Y", "%Y-%m", "%Y")
    whens = " ".join(f"WHEN {n} THEN strftime({d}, '{f}')" for n, f in enumerate(layouts))
    text = f"CASE {k} % 16 {whens} END"
    return f"CASE WHEN {k} % 16 = 11 THEN replace({text}, 'Sep', 'Sept') ELSE {text} END"


def _bool(k):
    words = ["Yes", "Hai", "1", "Working", "Nahi hai", "Kharab", "maybe"]
    return f"CASE ({k}) % 8 " + " ".join(f"WHEN {n} THEN '{w}'" for n, w in enumerate(words)) + " END"


def _dup(table, key):
    return f"(SELECT * FROM {table} UNION ALL SELECT * FROM {table} WHERE {key} % 25 = 0)"


# Normalisers -----------------------------------------------------------------------------


def norm_id(c):
    digits = f"ltrim(regexp_extract({c}, '[0-9]+'), '0')"
    return (f"CASE WHEN regexp_matches({c}, '[0-9]') THEN 'SCH' || repeat('0', greatest(4 - length({digits}), 0)) "
            f"|| {digits} ELSE upper(trim({c})) END")


def changed(raw, clean):
    return f"({raw} IS NULL OR {raw} IS DISTINCT FROM {clean})"


_ISO = r"\d{4}[-/]\d{1,2}[-/]\d{1,2}"
_DASH = r"\d{1,2}[-/]\d{1,2}[-/]\d{4}"
_DOT = r"\d{1,2}\.\d{1,2}\.\d{4}"
_MON4 = r"\d{1,2}-[A-Za-z]+-\d{4}"
_MON2 = r"\d{1,2}-[A-Za-z]{3}-\d{2}"


def _full(t, p):
    return f"regexp_full_match({t}, '{p}')"


def norm_date(t):
    """Value of a stripped date text."""
    first = f"TRY_CAST(regexp_extract({t}, '^(\\d+)', 1) AS INT)"
    second = f"TRY_CAST(regexp_extract({t}, '^\\d+\\D(\\d+)', 1) AS INT)"
    dashed = f"replace({t}, '/', '-')"
    return f"""CASE
      WHEN {_full(t, _ISO)} THEN TRY_CAST({dashed} AS DATE)
      WHEN {_full(t, _DASH)} AND {first} > 12 THEN try_strptime({dashed}, '%d-%m-%Y')::DATE
      WHEN {_full(t, _DASH)} THEN try_strptime({dashed}, '%m-%d-%Y')::DATE
      WHEN {_full(t, _DOT)} AND {first} <= 12 AND {second} > 12 THEN try_strptime({t}, '%m.%d.%Y')::DATE
      WHEN {_full(t, _DOT)} THEN try_strptime({t}, '%d.%m.%Y')::DATE
      WHEN {_full(t, _MON4)} THEN try_strptime({t}, ['%d-%b-%Y', '%d-%B-%Y'])::DATE
      WHEN {_full(t, _MON2)} THEN try_strptime({t}, '%d-%b-%y')::DATE
      WHEN {_full(t, '[0-9]{8}')} THEN try_strptime({t}, '%Y%m%d')::DATE
      WHEN {_full(t, '[A-Za-z]+ [0-9]{1,2},? [0-9]{4}')} THEN try_strptime(replace({t}, ',', ''), ['%b %d %Y', '%B %d %Y'])::DATE
      WHEN {_full(t, '[0-9]{1,2} [A-Za-z]+,? [0-9]{4}')} THEN try_strptime(replace({t}, ',', ''), ['%d %b %Y', '%d %B %Y'])::DATE
      WHEN {_full(t, '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9:]+')} THEN try_strptime({t}, '%Y-%m-%d %H:%M:%S')::DATE
      WHEN {_full(t, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}')} AND {first} > 12 THEN try_strptime({t}, '%d/%m/%y')::DATE
      WHEN {_full(t, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}')} THEN try_strptime({t}, '%m/%d/%y')::DATE
    END"""


def date_method(t, value):
    first = f"TRY_CAST(regexp_extract({t}, '^(\\d+)', 1) AS INT)"
    second = f"TRY_CAST(regexp_extract({t}, '^\\d+\\D(\\d+)', 1) AS INT)"
    return f"""CASE
      WHEN {t} IS NULL OR {t} = '' THEN 'MISSING'
      WHEN {_full(t, _ISO)} THEN CASE WHEN {value} IS NULL THEN 'INVALID_ISO' ELSE 'ISO_FORMAT' END
      WHEN {_full(t, _DOT)} THEN CASE WHEN {value} IS NULL THEN 'INVALID_DOT' WHEN {first} > 12 THEN 'DOT_DD_MM_YYYY'
        WHEN {second} > 12 THEN 'DOT_MM_DD_YYYY' ELSE 'DOT_DD_MM_AMBIGUOUS' END
      WHEN {_full(t, _DASH)} THEN CASE WHEN {value} IS NULL THEN 'INVALID_DASH' WHEN {first} > 12 THEN 'DASH_DD_MM_YYYY'
        WHEN {second} > 12 THEN 'DASH_MM_DD_YYYY' ELSE 'DASH_MM_DD_AMBIGUOUS' END
      WHEN {value} IS NULL THEN 'UNPARSED_ERROR'
      WHEN {_full(t, _MON4)} OR {_full(t, _MON2)} THEN 'TEXT_MONTH'
      ELSE 'PANDAS_FALLBACK' END"""


def norm_bool(c):
    return (f"CASE WHEN upper(trim({c})) IN ('TRUE','1','Y','YES','H','HAI','HAAN','WORKING','FUNCTIONAL','AVAILABLE') THEN TRUE "
            f"WHEN upper(trim({c})) IN ('FALSE','0','N','NO','NAHI','NAHI HAI','NA','KHARAB','BROKEN','UNDER REPAIR','NOT AVAILABLE') THEN FALSE END")


def norm_grade(c):
    romans = ["I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII"]
    whens = " ".join(f"WHEN upper(trim({c})) IN ('{r}', '{n}', 'GRADE {n}') THEN 'Grade {n}'" for n, r in enumerate(romans, 1))
    return f"CASE WHEN {c} IS NULL THEN 'Unknown' {whens} ELSE 'Grade ' || upper(trim({c})) END"


def title(c):
    return (f"array_to_string(list_transform(regexp_extract_all({c}, '[A-Za-z]+|[^A-Za-z]+'), "
            f"lambda w: upper(w[1]) || lower(w[2:])), '')")


def norm_grain(c):
    return (f"CASE upper(trim({c})) WHEN 'RICE' THEN 'Rice' WHEN 'CHAWAL' THEN 'Rice' WHEN 'RICE/CHAWAL' THEN 'Rice' "
            "WHEN 'WHEAT' THEN 'Wheat' WHEN 'GEHUN' THEN 'Wheat' WHEN 'ATTA' THEN 'Wheat' WHEN 'DAL' THEN 'Pulses' "
            "WHEN 'DAAL' THEN 'Pulses' WHEN 'PULSES' THEN 'Pulses' WHEN 'LENTILS' THEN 'Pulses' WHEN 'MUSTARD OIL' THEN 'Oil' "
            "WHEN 'SARSON TEL' THEN 'Oil' WHEN 'OIL' THEN 'Oil' WHEN 'COOKING OIL' THEN 'Oil' ELSE 'Other' END")


def norm_vendor(c):
    return (f"CASE WHEN upper(trim({c})) IN ('KUMAR & CO.','KUMAR GENERAL STORE','KUMAR SUPPLIES') THEN 'Kumar Enterprises' "
            f"WHEN upper(trim({c})) IN ('SINGH BROTHERS','SINGH AGRO','S. AGRO WORKS') THEN 'Singh Agro Group' "
            f"WHEN upper(trim({c})) IN ('SHARMA & SONS','SHARMA TRADERS PVT LTD','SHARMA TRADERS') THEN 'Sharma Traders' "
            f"WHEN upper(trim({c})) IN ('GOYAL ENTERPRISES','GOYAL MILL','GOYAL RICE MILL') THEN 'Goyal Mills' ELSE {title(c)} END")


def norm_subject(c):
    return (f"CASE WHEN upper(trim({c})) IN ('MATH','MATHEMATICS','GANIT') THEN 'Mathematics' WHEN upper(trim({c})) = 'EVS' THEN 'EVS' "
            f"WHEN upper(trim({c})) IN ('HINDI','ENGLISH','PUNJABI','SCIENCE') THEN {title(f'trim({c})')} ELSE {title(c)} END")


def norm_payment(c):
    return (f"CASE WHEN upper(trim({c})) IN ('PAID','CLEARED') THEN 'Paid' WHEN upper(trim({c})) IN ('PENDING','DUE') THEN 'Pending' "
            "ELSE 'Unknown' END")


def norm_cost(c):
    return (f"TRY_CAST(trim(replace(replace(replace(replace(replace({c}, '₹', ''), 'Rs.', ''), 'Rs', ''), '/-', ''), ',', '')) AS DOUBLE)")


# Common tables ---------------------------------------------------------------------------

_DATE_COLUMNS = "school_id_raw, school_id_clean, school_id_changed_flag, date_raw, date_clean, date_parse_method, date_ambiguous_flag, date_parse_error_flag"


def _tie_break(columns):
    values = ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(30))" for c in columns)
    return f"md5(concat_ws(chr(31), {values}))"


def _dedup_keyed(raw):
    """De-duplicated rows with id and date normalised; raw texts keep their names with `_raw`."""
    return f"""
      SELECT * EXCLUDE (school_id, date), school_id AS school_id_raw, date AS date_raw, trim(date) AS t,
        {norm_id('school_id')} AS school_id, {norm_date('trim(date)')} AS date
      FROM (SELECT *, count(*) AS exact_copies FROM {raw} GROUP BY ALL)"""


_SCHOOL_TIES = ["school_name", "school_id_raw", "district_raw", "block_raw", "school_type", "medium"]
_SCHOOL_ORDER = f"total_enrolled_students DESC NULLS LAST, {_tie_break(_SCHOOL_TIES)} DESC"


def _keyed_columns(alias="d"):
    method = date_method(f"{alias}.t", f"{alias}.date")
    return f"""{alias}.school_id_raw, {alias}.school_id AS school_id_clean,
        {changed(f'{alias}.school_id_raw', f'{alias}.school_id')} AS school_id_changed_flag,
        {alias}.date_raw, {alias}.date AS date_clean, {method} AS date_parse_method,
        ({alias}.date IS NOT NULL AND NOT {_full(f'{alias}.t', _MON4)} AND NOT {_full(f'{alias}.t', _MON2)}
          AND ({method} LIKE '%AMBIGUOUS' OR {method} = 'PANDAS_FALLBACK')) AS date_ambiguous_flag,
        {alias}.date IS NULL AS date_parse_error_flag"""


def _raw_attendance(school):
    return f"""
      SELECT printf('ATT%d-%d-%d', l_orderkey, l_linenumber, l_partkey) AS record_id, {_known_id(school, 'l_orderkey')} AS school_id,
        {_date('l_shipdate', 'l_partkey')} AS date,
        CASE l_partkey % 3 WHEN 0 THEN printf('%d', l_linenumber)
          WHEN 1 THEN ['I', 'II', 'III', 'IV', 'V', 'VI', 'Nursery'][l_linenumber]
          ELSE printf('grade %d', l_linenumber) END AS grade,
        CASE WHEN l_suppkey % 97 = 0 THEN 0 ELSE 45 END AS total_students,
        CASE WHEN l_suppkey % 97 = 0 THEN 0 WHEN o_custkey % 40 = 1 THEN CAST(floor(l_quantity / 25) AS INT)
          ELSE CAST(floor(l_quantity) AS INT) END AS present_students,
        {_bool('l_suppkey')} AS teacher_present, l_returnflag AS marked_by
      FROM {_dup('lineitem', 'l_orderkey')} l JOIN orders ON l_orderkey = o_orderkey"""


_TABLES = {
    "raw_school": f"""
      SELECT CASE WHEN c_custkey % 97 = 5 THEN NULL WHEN record = 1 THEN printf('%d', c_custkey)
          WHEN record = 2 THEN printf('sch-%d', c_custkey) ELSE {_id('c_custkey')} END AS school_id,
        CASE WHEN record = 2 THEN 'Old ' || c_name WHEN record = 1 OR c_custkey % 10 <> 3 THEN c_name END AS school_name,
        CASE WHEN c_custkey % 50 = 7 OR record = 2 THEN NULL WHEN c_custkey % 3 = 0 THEN lower(n_name)
          WHEN c_custkey % 3 = 1 THEN upper(n_name) ELSE '  ' || n_name || ' ' END AS district,
        CASE WHEN c_custkey % 31 <> 4 THEN r_name END AS block,
        CASE WHEN c_custkey % 29 = 6 THEN NULL WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS school_type,
        CASE c_custkey % 4 WHEN 0 THEN 'punjabi' WHEN 1 THEN 'HINDI' WHEN 2 THEN 'English' END AS medium,
        CAST(CASE WHEN record = 2 OR c_custkey % 41 = 8 THEN NULL WHEN record = 1 THEN 50 + c_custkey % 40
          ELSE 100 + c_custkey % 900 END AS INT) AS total_enrolled_students
      FROM (SELECT *, unnest(CASE WHEN c_custkey % 10 = 3 THEN [0, 1, 2] ELSE [0] END) AS record FROM {_dup('customer', 'c_custkey')}) c
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "raw_attendance": _raw_attendance("o_custkey"),
    "raw_procurement": f"""
      SELECT printf('MDM%07d', o_orderkey) AS procurement_id, {_known_id('o_custkey', 'o_orderkey')} AS school_id,
        {_date('o_orderdate', 'o_orderkey')} AS date,
        CASE WHEN o_orderkey % 37 <> 5 THEN ['Kumar & Co.', 'SINGH AGRO', 'sharma & sons', 'Goyal Mill', 'verma stores'][1 + o_orderkey % 5] END
          AS vendor_name,
        ['chawal', 'ATTA', 'Daal', 'Sarson Tel', 'Kanak', NULL][1 + o_orderkey % 6] AS grain_type,
        CASE WHEN o_orderkey % 43 = 7 THEN 'some' WHEN o_orderkey % 7 = 0 THEN printf('%d kg', 1 + o_custkey % 90)
          WHEN o_orderkey % 7 < 6 THEN printf('%d', 1 + o_custkey % 900) END AS quantity,
        CASE o_orderkey % 7 WHEN 1 THEN 'KG' WHEN 2 THEN 'Grams' WHEN 3 THEN '50kg Bags' WHEN 4 THEN 'sacks' END AS unit,
        CASE o_orderkey % 5 WHEN 0 THEN printf('₹%d', n) WHEN 1 THEN printf('Rs. %d', n) WHEN 2 THEN printf('%d/-', n)
          WHEN 3 THEN printf('1,%03d', n % 1000) ELSE 'tbd' END AS total_cost,
        CASE o_orderstatus WHEN 'F' THEN 'cleared' WHEN 'O' THEN 'Due' ELSE 'part' END AS payment_status
      FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS n FROM {_dup('orders', 'o_orderkey')})""",
    "raw_infra": f"""
      SELECT {_known_id('user_id', 'event_id')} AS school_id, {_date('ts', 'event_id')} AS date,
        {', '.join(f"CASE WHEN user_id % 40 = 1 THEN 'Nahi hai' ELSE {_bool(f'event_id + {m} * user_id')} END AS {a}" for a, m in zip(AMENITIES, (1, 3, 5, 7, 11)))},
        event_type AS inspector_name, props AS remarks
      FROM {_dup('events', 'event_id')}""",
    "raw_scores": f"""
      SELECT printf('TST%07d', event_id) AS assessment_id, {_known_id('user_id', 'event_id')} AS school_id, {_date('ts', 'event_id')} AS date,
        printf('Grade %d', 1 + event_id % 12) AS grade,
        CASE WHEN event_id % 47 <> 9 THEN ['ganit', 'HINDI', 'evs', 'art craft'][1 + event_id % 4] END AS subject,
        CASE WHEN user_id % 40 = 1 THEN '%' ELSE ['%', 'pct', 'Letter Grade', 'Raw Marks', 'CGPA', 'Raw Marks', 'Raw Marks', NULL][1 + event_id % 8] END AS grading_scale,
        CASE WHEN user_id % 40 = 1 THEN printf('%d', p % 7) || '%' ELSE CASE event_id % 8 WHEN 0 THEN printf('%d', p % 101) || '%' WHEN 1 THEN printf('%d', p % 101)
          WHEN 2 THEN ['A+', 'b', 'F', 'absent'][1 + user_id % 4] WHEN 3 THEN printf('%d/50', p % 51)
          WHEN 4 THEN printf('%d.5', p % 10) WHEN 5 THEN printf('%d', p % 41) WHEN 6 THEN '7/0' END END AS avg_score,
        CASE event_id % 8 WHEN 4 THEN '10' WHEN 5 THEN '40' END AS max_marks
      FROM (SELECT *, event_id * 13 + user_id AS p FROM {_dup('events', 'event_id')})""",
    # One row per school: the window form of the merge.
    "school_rows": f"""
      SELECT school_id AS school_id_raw, {norm_id('school_id')} AS school_id, school_name, district AS district_raw,
        block AS block_raw, {title("trim(coalesce(district, 'Unknown District'))")} AS district,
        {title("trim(coalesce(block, 'Unknown Block'))")} AS block,
        {title("trim(coalesce(school_type, 'Unknown'))")} AS school_type,
        {title("trim(coalesce(medium, 'Unknown'))")} AS medium, total_enrolled_students, exact_copies
      FROM (SELECT *, count(*) AS exact_copies FROM raw_school GROUP BY ALL)""",
    "school": f"""
      SELECT school_id, first_value(school_name IGNORE NULLS) OVER w AS school_name, district, block, school_type, medium,
        first_value(total_enrolled_students IGNORE NULLS) OVER w AS total_enrolled_students, school_id_raw,
        school_id AS school_id_clean, {changed('school_id_raw', 'school_id')} AS school_id_changed_flag,
        district_raw, district AS district_clean, block_raw, block AS block_clean
      FROM school_rows WHERE school_id IS NOT NULL
      WINDOW o AS (PARTITION BY school_id ORDER BY {_SCHOOL_ORDER}),
        w AS (PARTITION BY school_id ORDER BY {_SCHOOL_ORDER}
          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
      QUALIFY row_number() OVER o = 1""",
    "attendance_flags": f"""
      SELECT *, coalesce(present_students > total_students, FALSE) AS imp,
        coalesce(isodow(date) = 7, FALSE) AS is_sunday, coalesce(isodow(date) >= 6, FALSE) AS is_weekend,
        CASE WHEN total_students > 0 AND NOT coalesce(present_students > total_students, FALSE)
          THEN present_students / total_students * 100.0::DOUBLE END AS rate
      FROM ({_dedup_keyed('raw_attendance')})""",
    "attendance": f"""
      SELECT record_id, school_id, date, {norm_grade('grade')} AS grade, total_students, present_students,
        {norm_bool('teacher_present')} AS teacher_present, marked_by, {_keyed_columns()}, grade AS grade_raw,
        {norm_grade('grade')} AS grade_clean, teacher_present AS teacher_present_raw,
        {norm_bool('teacher_present')} AS teacher_present_clean,
        ({norm_bool('teacher_present')}) IS NULL AS teacher_present_is_unknown_flag,
        imp AS is_impossible_attendance, rate AS attendance_rate, is_weekend, is_sunday,
        coalesce(is_sunday AND present_students > 0 AND rate >= 99.9, FALSE) AS is_proxy_attendance,
        CASE WHEN imp THEN 'INVALID_IMPOSSIBLE_ATTENDANCE'
          WHEN coalesce(is_sunday AND present_students > 0 AND rate >= 99.9, FALSE) THEN 'ANOMALY_PROXY_SUNDAY'
          WHEN total_students <= 0 THEN 'INVALID_ZERO_TOTAL' WHEN date IS NULL THEN 'INVALID_DATE_FORMAT' ELSE 'VALID' END
          AS data_quality_status, exact_copies
      FROM attendance_flags d""",
    "procurement_parsed": f"""
      SELECT *, TRY_CAST(nullif(regexp_extract(quantity, '([0-9]+\\.?[0-9]*)\\s*([a-zA-Z]+)?', 1), '') AS DOUBLE) AS q,
        CASE WHEN trim(coalesce(unit, '')) <> '' THEN lower(trim(unit))
          ELSE lower(regexp_extract(quantity, '([0-9]+\\.?[0-9]*)\\s*([a-zA-Z]+)?', 2)) END AS u,
        {norm_cost('total_cost')} AS cost
      FROM ({_dedup_keyed('raw_procurement')})""",
    "procurement_kg": """
      SELECT *, CASE WHEN quantity IS NULL AND unit IS NULL THEN 'MISSING_QUANTITY_AND_UNIT' WHEN q IS NULL THEN 'UNPARSED_QUANTITY'
          WHEN u IN ('kg', 'kgs', 'kilogram', 'kilograms') THEN 'DIRECT' WHEN u IN ('g', 'gram', 'grams') THEN 'GRAMS_TO_KG'
          WHEN u IN ('50kg bags', 'bags', 'sacks', 'bori', 'bag', 'sack') THEN 'BAGS_50KG_TO_KG'
          WHEN q > 500 THEN 'INFERRED_GRAMS_TO_KG' WHEN q <= 10 THEN 'INFERRED_BAGS_TO_KG' ELSE 'INFERRED_ASSUMED_KG' END AS method,
        CASE WHEN method LIKE '%GRAMS%' THEN q * 0.001::DOUBLE WHEN method LIKE '%BAGS%' THEN q * 50.0::DOUBLE ELSE q END AS kg
      FROM procurement_parsed""",
    "procurement": f"""
      SELECT procurement_id, school_id, date, {norm_vendor('vendor_name')} AS vendor_name, {norm_grain('grain_type')} AS grain_type,
        quantity, unit, cost AS total_cost, {norm_payment('payment_status')} AS payment_status, {_keyed_columns()},
        grain_type AS grain_raw, {norm_grain('grain_type')} AS grain_clean, vendor_name AS vendor_raw,
        {norm_vendor('vendor_name')} AS vendor_clean, quantity AS quantity_raw, unit AS unit_raw, kg AS quantity_kg,
        CASE WHEN q IS NULL THEN 'Unknown' ELSE 'KG' END AS unit_clean, method AS conversion_method,
        (q IS NULL OR method LIKE 'INFERRED%') AS unit_inferred_flag, total_cost AS cost_raw, cost AS total_cost_numeric,
        CASE WHEN kg > 0 THEN cost / kg END AS cost_per_kg, payment_status AS payment_status_raw,
        {norm_payment('payment_status')} AS payment_status_clean, exact_copies
      FROM procurement_kg d""",
    "infra_bools": f"""
      SELECT * EXCLUDE ({', '.join(AMENITIES)}), {', '.join(f'{a} AS {a}_raw, {norm_bool(a)} AS {a}' for a in AMENITIES)}
      FROM ({_dedup_keyed('raw_infra')})""",
    "infra_counts": f"""
      SELECT *, CAST({' + '.join(f'coalesce({a}, FALSE)::INT' for a in AMENITIES)} AS DOUBLE) AS yes,
        CAST({' + '.join(f'coalesce(NOT {a}, FALSE)::INT' for a in AMENITIES)} AS DOUBLE) AS no
      FROM infra_bools""",
    "infra_history": f"""
      SELECT school_id, date, {', '.join(AMENITIES)}, inspector_name, remarks, {_keyed_columns()},
        {', '.join(f'{a}_raw, {a} AS {a}_clean, {a} IS NULL AS {a}_is_unknown_flag' for a in AMENITIES)},
        yes AS amenities_functional_count, no AS amenities_deficit_count,
        CASE WHEN yes + no > 0 THEN yes / 5.0::DOUBLE * 100.0::DOUBLE END AS infrastructure_score,
        CASE WHEN yes + no > 0 THEN no / 5.0::DOUBLE * 100.0::DOUBLE END AS infrastructure_deficit_pct, exact_copies
      FROM infra_counts d""",
    "infra_current": "",
    "scores_parsed": f"""
      SELECT *, trim(avg_score) AS s, coalesce(lower(trim(grading_scale)), '') AS sc,
        TRY_CAST(trim(replace(trim(avg_score), '%', '')) AS DOUBLE) AS amount,
        TRY_CAST(trim(string_split(avg_score, '/')[1]) AS DOUBLE) AS above,
        TRY_CAST(trim(string_split(avg_score, '/')[2]) AS DOUBLE) AS below,
        TRY_CAST(max_marks AS DOUBLE) AS mx,
        CASE upper(trim(avg_score)) WHEN 'A+' THEN 95.0 WHEN 'A' THEN 85.0 WHEN 'B' THEN 75.0 WHEN 'C' THEN 65.0
          WHEN 'D' THEN 55.0 WHEN 'E' THEN 45.0 WHEN 'F' THEN 35.0 END::DOUBLE AS letter
      FROM ({_dedup_keyed('raw_scores')})""",
    "scores_method": """
      SELECT *, CASE WHEN s IS NULL THEN 'MISSING_SCORE'
          WHEN contains(s, '%') OR sc IN ('pct', '%', 'percentage')
            THEN CASE WHEN amount IS NULL THEN 'INVALID_PERCENTAGE' ELSE 'PERCENTAGE_DIRECT' END
          WHEN letter IS NOT NULL THEN 'LETTER_GRADE_MIDPOINT'
          WHEN contains(s, '/') AND (above IS NULL OR below IS NULL) THEN 'INVALID_RAW_MARKS'
          WHEN contains(s, '/') AND below > 0 THEN 'RAW_MARKS_RATIO'
          WHEN sc = 'cgpa' OR trim(max_marks) = '10' THEN CASE WHEN amount IS NULL THEN 'INVALID_CGPA' ELSE 'CGPA_MULTIPLY_9_5' END
          WHEN amount IS NULL THEN 'UNPARSED_SCORE_ERROR'
          WHEN mx > 0 AND mx <> 100 THEN 'RAW_MARKS_WITH_JSON_MAX' ELSE 'DIRECT_FLOAT' END AS method
      FROM scores_parsed""",
    "scores": f"""
      SELECT assessment_id, school_id, date, grade, {norm_subject('subject')} AS subject, grading_scale, avg_score, max_marks,
        {_keyed_columns()}, subject AS subject_raw, {norm_subject('subject')} AS subject_clean, grading_scale AS grading_scale_raw,
        avg_score AS avg_score_raw,
        CASE method WHEN 'PERCENTAGE_DIRECT' THEN amount WHEN 'DIRECT_FLOAT' THEN amount WHEN 'LETTER_GRADE_MIDPOINT' THEN letter
          WHEN 'RAW_MARKS_RATIO' THEN above / below * 100.0::DOUBLE WHEN 'CGPA_MULTIPLY_9_5' THEN amount * 9.5::DOUBLE
          WHEN 'RAW_MARKS_WITH_JSON_MAX' THEN amount / mx * 100.0::DOUBLE END AS score_percentage,
        method AS score_conversion_method,
        method IN ('PERCENTAGE_DIRECT', 'DIRECT_FLOAT', 'LETTER_GRADE_MIDPOINT', 'RAW_MARKS_RATIO', 'CGPA_MULTIPLY_9_5',
          'RAW_MARKS_WITH_JSON_MAX') AS score_valid_flag, exact_copies
      FROM scores_method d""",
    "att_kpi": """
      SELECT school_id, avg(CASE WHEN data_quality_status = 'VALID' THEN attendance_rate END) AS avg_attendance_rate,
        sum(CASE WHEN is_proxy_attendance THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*) AS proxy_anomaly_rate
      FROM attendance GROUP BY school_id""",
    "score_kpi": "SELECT school_id, avg(score_percentage) AS avg_fln_score FROM scores GROUP BY school_id",
    "mdm_kpi": """
      SELECT school_id, sum(quantity_kg) AS total_quantity_kg, sum(total_cost) AS total_cost
      FROM procurement GROUP BY school_id""",
    "kpis": """
      SELECT s.*, avg_attendance_rate, proxy_anomaly_rate, infrastructure_score, infrastructure_deficit_pct, avg_fln_score,
        total_quantity_kg, total_cost
      FROM school s LEFT JOIN att_kpi a ON s.school_id = a.school_id
        LEFT JOIN infra_current i ON s.school_id = i.school_id
        LEFT JOIN score_kpi t ON s.school_id = t.school_id LEFT JOIN mdm_kpi m ON s.school_id = m.school_id""",
    "monthly": """
      SELECT district, strftime(date, '%Y-%m') AS month, count(record_id) AS total_records,
        avg(CASE WHEN data_quality_status = 'VALID' THEN attendance_rate END) AS avg_attendance_rate,
        CAST(sum(CASE WHEN is_proxy_attendance THEN 1 ELSE 0 END) AS BIGINT) AS proxy_anomaly_records,
        CAST(sum(CASE WHEN is_impossible_attendance THEN 1 ELSE 0 END) AS BIGINT) AS impossible_records,
        sum(CASE WHEN is_proxy_attendance THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(record_id) AS proxy_anomaly_rate_pct
      FROM attendance a LEFT JOIN school s ON a.school_id = s.school_id GROUP BY ALL""",
    "district_kpis": """
      SELECT district, count(DISTINCT school_id) AS total_schools,
        CAST(sum(total_enrolled_students) AS BIGINT) AS total_enrolled_students,
        avg(avg_attendance_rate) AS avg_attendance_rate, avg(proxy_anomaly_rate) AS proxy_anomaly_rate,
        avg(infrastructure_score) AS avg_infrastructure_score, avg(infrastructure_deficit_pct) AS avg_infrastructure_deficit,
        avg(avg_fln_score) AS avg_fln_score, sum(total_quantity_kg) AS total_mdm_quantity_kg, sum(total_cost) AS total_mdm_cost
      FROM kpis GROUP BY district""",
    "daily": """
      SELECT record_id, a.school_id, school_name, district, block, school_type, date AS attendance_date, grade, total_students,
        present_students, attendance_rate, teacher_present, marked_by, is_impossible_attendance, is_proxy_attendance, is_weekend,
        data_quality_status
      FROM attendance a LEFT JOIN school s ON a.school_id = s.school_id""",
    "risk_inputs": """
      SELECT school_id, school_name, district, block, total_enrolled_students,
        coalesce(avg_attendance_rate, 75.0::DOUBLE) AS avg_attendance_rate, coalesce(proxy_anomaly_rate, 0.0::DOUBLE) AS proxy_anomaly_rate,
        coalesce(infrastructure_deficit_pct, 40.0::DOUBLE) AS infrastructure_deficit_pct,
        coalesce(infrastructure_score, 60.0::DOUBLE) AS infrastructure_score, coalesce(avg_fln_score, 65.0::DOUBLE) AS avg_fln_score,
        coalesce(total_quantity_kg, 0.0::DOUBLE) AS total_mdm_kg
      FROM kpis""",
    "risk_parts": """
      SELECT *, least(greatest(100.0::DOUBLE - avg_attendance_rate, 0), 100) AS attendance_risk,
        least(greatest(100.0::DOUBLE - avg_fln_score, 0), 100) AS learning_risk,
        least(greatest(infrastructure_deficit_pct, 0), 100) AS infrastructure_risk,
        CASE WHEN total_mdm_kg < total_enrolled_students * 0.5::DOUBLE THEN 60.0::DOUBLE ELSE 20.0::DOUBLE END AS mdm_risk,
        least(greatest(proxy_anomaly_rate, 0), 100) AS integrity_risk
      FROM risk_inputs""",
    "risk": """
      SELECT *, round_even(round(attendance_risk * 0.30::DOUBLE + learning_risk * 0.25::DOUBLE + infrastructure_risk * 0.20::DOUBLE
          + mdm_risk * 0.15::DOUBLE + integrity_risk * 0.10::DOUBLE, 9), 2) AS welfare_risk_score,
        CASE WHEN welfare_risk_score < 40 THEN 'Low Risk' WHEN welfare_risk_score < 70 THEN 'Moderate Risk'
          WHEN welfare_risk_score >= 70 THEN 'High Risk' ELSE 'Moderate Risk' END AS welfare_risk_category
      FROM risk_parts""",
}


def _current():
    columns = ["school_id_raw", "school_id_clean", "school_id_changed_flag", "date_raw", "date_parse_method",
               "date_ambiguous_flag", "date_parse_error_flag", *[f"{a}_raw" for a in AMENITIES],
               *[f"{a}_is_unknown_flag" for a in AMENITIES], "amenities_functional_count", "amenities_deficit_count"]
    filled = [*AMENITIES, "inspector_name", "remarks", "infrastructure_score", "infrastructure_deficit_pct"]
    ties = ["school_id_raw", "date_raw", "inspector_name", "remarks", *[f"{a}_raw" for a in AMENITIES]]
    order = f"date DESC NULLS LAST, {_tie_break(ties)} DESC"

    def latest(c):
        return f"first_value({c} IGNORE NULLS) OVER w"

    return f"""
      SELECT school_id, {latest('date')} AS date, {latest('date')} AS date_clean, {', '.join(columns)},
        {', '.join(f'{latest(c)} AS {c}' for c in filled)}, {', '.join(f'{latest(a)} AS {a}_clean' for a in AMENITIES)}
      FROM infra_history WHERE school_id IS NOT NULL
      WINDOW o AS (PARTITION BY school_id ORDER BY {order}),
        w AS (PARTITION BY school_id ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
      QUALIFY row_number() OVER o = 1"""


_TABLES["infra_current"] = _current()


def _needs(text):
    import re

    words = set(re.findall(r"[a-z_]+", text))
    return [name for name in _TABLES if name in words]


def twin(body, **others):
    """A query text with the common tables it refers to, directly or through others; `others` replaces some of them."""
    wanted, todo = set(), _needs(body)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += _needs(_TABLES[name])
    tables = ", ".join(f"{name} AS ({others.get(name, _TABLES[name])})" for name in _TABLES if name in wanted)
    return f"WITH {tables} {body}" if tables else body


# Twins -----------------------------------------------------------------------------------

RISK_COLUMNS = ["school_id", "school_name", "district", "block", "total_enrolled_students"]
RISK_MEASURES = ["avg_attendance_rate", "proxy_anomaly_rate", "infrastructure_deficit_pct", "infrastructure_score",
                 "avg_fln_score", "total_mdm_kg", "attendance_risk", "learning_risk", "infrastructure_risk", "mdm_risk",
                 "integrity_risk", "welfare_risk_score"]


def all_twins(district, school_type, digits, since, until, stored):
    def r(expression, name=None):
        return f"round({expression}, {digits}) AS {name or expression}"

    def rs(*names):
        return ", ".join(r(n) for n in names)

    daily = "SELECT school_id, school_name, district, attendance_date, present_students, total_students, marked_by FROM daily"
    proxy_order = ("ORDER BY attendance_date DESC NULLS LAST, school_id NULLS LAST, {}present_students NULLS LAST, "
                   "total_students NULLS LAST, marked_by NULLS LAST")
    priority = ["school_id", "school_name", "district", "block"]
    priority_measures = ["avg_attendance_rate", "avg_fln_score", "infrastructure_deficit_pct"]
    priority_sql = (f"SELECT {', '.join(priority)}, welfare_risk_score, welfare_risk_category, {rs(*priority_measures)} "
                    "FROM risk ORDER BY welfare_risk_score DESC NULLS LAST, school_id NULLS LAST")
    risk_sql = f"SELECT {', '.join(RISK_COLUMNS)}, {rs(*RISK_MEASURES)}, welfare_risk_category FROM risk"
    compare = "SELECT district, avg(avg_attendance_rate) AS att_rate, avg(avg_fln_score) AS fln_score FROM district_kpis GROUP BY district"
    kpi = f"""SELECT count(DISTINCT school_id) AS total_schools, CAST(sum(total_enrolled_students) AS BIGINT) AS total_enrollment,
        {r('avg(avg_attendance_rate)', 'overall_attendance')}, {r('avg(proxy_anomaly_rate)', 'proxy_anomaly_rate')},
        {r('avg(infrastructure_deficit_pct)', 'avg_infra_deficit')}, {r('avg(avg_fln_score)', 'avg_fln_score')} FROM kpis"""

    def counter(dataset, metric, value, table):
        return (f"SELECT '{dataset}' AS dataset, '{metric}' AS metric, CAST(NULL AS VARCHAR) AS key, "
                f"CAST(coalesce({value}, 0) AS BIGINT) AS value FROM {table}")

    def row_counts(dataset, raw, clean, retained="retained_rows"):
        return [
            counter(dataset, "raw_rows", "count(*)", raw),
            counter(dataset, "exact_duplicates", f"count(*) - (SELECT count(*) FROM {clean})", raw),
            counter(dataset, retained, "count(*)", clean),
        ]

    def flags(dataset, table, **conditions):
        return [counter(dataset, metric, f"sum(({c})::INT)", table) for metric, c in conditions.items()]

    histogram = ("SELECT 'test_scores' AS dataset, 'scale_breakdown' AS metric, grading_scale AS key, "
                 "count(*) AS value FROM scores GROUP BY grading_scale")
    audit = [
        counter("school_master", "raw_rows", "count(*)", "raw_school"),
        counter("school_master", "exact_duplicates", "count(*) - (SELECT count(*) FROM school_rows)", "raw_school"),
        counter("school_master", "retained_unique_schools", "count(*)", "school"),
        counter("school_master", "missing_districts_imputed", "count(*)", "school WHERE district_raw IS NULL"),
        *row_counts("student_attendance", "raw_attendance", "attendance"),
        *flags("student_attendance", "attendance", impossible_attendance_count="is_impossible_attendance",
               proxy_attendance_count="is_proxy_attendance", valid_records_count="data_quality_status = 'VALID'"),
        *row_counts("mdm_procurement", "raw_procurement", "procurement"),
        *flags("mdm_procurement", "procurement", missing_units_count="unit IS NULL",
               inferred_units_count="unit_inferred_flag", invalid_costs_count="total_cost IS NULL"),
        *row_counts("school_infrastructure", "raw_infra", "infra_history", "history_rows"),
        counter("school_infrastructure", "unique_schools_current", "count(*)", "infra_current"),
        counter("school_infrastructure", "normalized_booleans_count", "count(*) * 5", "infra_history"),
        *row_counts("test_scores", "raw_scores", "scores"),
        *flags("test_scores", "scores", valid_scores_count="score_valid_flag", invalid_scores_count="NOT score_valid_flag"),
        histogram,
    ]
    line = f"(SELECT *, {_bool('l_suppkey')} AS word, CASE WHEN l_partkey % 3 = 0 THEN l_partkey END AS part FROM lineitem)"
    line_order = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_linenumber DESC"
    whole = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    dates = f"(SELECT o_orderkey, d AS date_raw, trim(d) AS t, {norm_date('trim(d)')} AS date FROM (SELECT o_orderkey, {_rare_date('o_orderdate', 'o_orderkey')} AS d FROM orders))"
    method = date_method("t", "date")

    bodies = {
        "normalize_id": f"""SELECT c_custkey, {norm_id('s')} AS school_id, s AS school_id_raw, {norm_id('s')} AS school_id_clean,
            {changed('s', norm_id('s'))} AS school_id_changed_flag, {norm_id('c_name')} AS name_id, {norm_id('c_mktsegment')} AS segment_id
            FROM (SELECT *, {_id('c_custkey')} AS s FROM customer)""",
        "normalize_date": f"""SELECT o_orderkey, date, date_raw, date AS date_clean, {method} AS date_parse_method,
            (date IS NOT NULL AND ({method}) IN ('DOT_DD_MM_AMBIGUOUS', 'DASH_MM_DD_AMBIGUOUS', 'PANDAS_FALLBACK')) AS date_ambiguous_flag,
            date IS NULL AS date_parse_error_flag FROM {dates}""",
        "normalize_date_fallback": f"""SELECT o_orderkey, v AS date, d AS date_raw, v AS date_clean,
            CASE WHEN k = 10 AND month(v) = 5 THEN 'TEXT_MONTH' ELSE 'PANDAS_FALLBACK' END AS date_parse_method,
            NOT (k = 10 AND month(v) = 5) AS date_ambiguous_flag, FALSE AS date_parse_error_flag
            FROM (SELECT o_orderkey, o_orderkey % 16 AS k, {_fallback_date('o_orderdate', 'o_orderkey')} AS d,
              CAST(CASE WHEN o_orderkey % 16 IN (13, 14) THEN date_trunc('month', o_orderdate)
                WHEN o_orderkey % 16 = 15 THEN date_trunc('year', o_orderdate) ELSE o_orderdate END AS DATE) AS v FROM orders)""",
        "normalize_boolean": f"""SELECT event_id, {norm_bool('w')} AS working, w AS working_raw, {norm_bool('w')} AS working_clean,
            ({norm_bool('w')}) IS NULL AS working_is_unknown_flag, {norm_bool('event_type')} AS kind, event_type AS kind_raw,
            {norm_bool('event_type')} AS kind_clean, ({norm_bool('event_type')}) IS NULL AS kind_is_unknown_flag
            FROM (SELECT *, {_bool('event_id + user_id')} AS w FROM events)""",
        "normalize_grade": f"SELECT record_id, grade AS grade_raw, {norm_grade('grade')} AS grade FROM raw_attendance",
        "normalize_quantity": """SELECT procurement_id, quantity_kg, unit_clean, conversion_method, unit_inferred_flag
            FROM (SELECT *, unnest(range(exact_copies)) AS copy FROM procurement)""",
        "normalize_cost": f"SELECT procurement_id, total_cost, {norm_cost('total_cost')} AS cost FROM raw_procurement",
        "normalize_score": """SELECT assessment_id, score_percentage, score_conversion_method, score_valid_flag
            FROM (SELECT *, unnest(range(exact_copies)) AS copy FROM scores)""",
        "map_category": f"""SELECT procurement_id, {norm_grain('grain_type')} AS grain, {norm_vendor('vendor_name')} AS vendor,
            {norm_payment('payment_status')} AS payment FROM raw_procurement""",
        "map_subject": f"SELECT assessment_id, {norm_subject('subject')} AS subject FROM raw_scores",
        "title_case": f"""SELECT p_partkey, {title('n')} AS title
            FROM (SELECT p_partkey, p_name || '-' || p_brand || '''' || p_type AS n FROM part)""",
        "dedup_exact": "SELECT l_orderkey, l_linenumber, count(*) AS exact_copies FROM lineitem GROUP BY ALL",
        "first_non_null_per_key": f"""SELECT l_orderkey, l_linenumber, l_suppkey, first_value(word IGNORE NULLS) OVER w AS word,
            first_value(part IGNORE NULLS) OVER w AS part FROM {line}
            WINDOW o AS (PARTITION BY l_orderkey ORDER BY {line_order}), w AS (PARTITION BY l_orderkey ORDER BY {line_order} {whole})
            QUALIFY row_number() OVER o = 1""",
        "latest_snapshot": f"""SELECT user_id, event_id, event_type, first_value(state IGNORE NULLS) OVER w AS state
            FROM (SELECT *, {_bool('event_id')} AS state FROM events)
            WINDOW o AS (PARTITION BY user_id ORDER BY ts DESC, event_id DESC),
              w AS (PARTITION BY user_id ORDER BY ts DESC, event_id DESC {whole})
            QUALIFY row_number() OVER o = 1""",
        "school_master_clean": "SELECT * FROM school",
        "attendance_clean": "SELECT * FROM attendance",
        "procurement_clean": "SELECT * FROM procurement",
        "infra_history": "SELECT * FROM infra_history",
        "infra_current": "SELECT * FROM infra_current",
        "scores_clean": "SELECT * FROM scores",
        "audit_counts": " UNION ALL ".join(audit),
        "scale_histogram": histogram,
        "attendance_daily": "SELECT * FROM daily",
        "attendance_monthly": f"""SELECT district, month, total_records, {rs('avg_attendance_rate')}, proxy_anomaly_records,
            impossible_records, {rs('proxy_anomaly_rate_pct')} FROM monthly""",
        "procurement_summary": """SELECT procurement_id, m.school_id, school_name, district, block, date AS procurement_date,
            vendor_name, grain_type, quantity_kg, total_cost, cost_per_kg, payment_status, unit_inferred_flag
            FROM procurement m LEFT JOIN school s ON m.school_id = s.school_id""",
        "infra_summary": f"""SELECT i.school_id, school_name, district, block, date AS last_inspection_date, {', '.join(AMENITIES)},
            infrastructure_score, infrastructure_deficit_pct, inspector_name, remarks
            FROM infra_current i LEFT JOIN school s ON i.school_id = s.school_id""",
        "test_summary": """SELECT assessment_id, t.school_id, school_name, district, block, date AS assessment_date, grade, subject,
            grading_scale_raw, avg_score_raw, score_percentage FROM scores t LEFT JOIN school s ON t.school_id = s.school_id""",
        "school_kpis": f"""SELECT * EXCLUDE (avg_attendance_rate, proxy_anomaly_rate, infrastructure_score, infrastructure_deficit_pct,
            avg_fln_score, total_quantity_kg, total_cost), {rs('avg_attendance_rate', 'proxy_anomaly_rate', 'infrastructure_score',
            'infrastructure_deficit_pct', 'avg_fln_score', 'total_quantity_kg', 'total_cost')} FROM kpis""",
        "district_summary": f"""SELECT district, total_schools, total_enrolled_students, {rs('avg_attendance_rate', 'proxy_anomaly_rate',
            'avg_infrastructure_score', 'avg_infrastructure_deficit', 'avg_fln_score', 'total_mdm_quantity_kg', 'total_mdm_cost')}
            FROM district_kpis""",
        "kpi_all": kpi,
        "kpi_scoped": f"{kpi} WHERE district = '{district}' AND school_type = '{school_type}'",
        "district_compare": f"SELECT district, {rs('att_rate', 'fln_score')} FROM ({compare})",
        "district_compare_long": f"""SELECT district, 'att_rate' AS indicator, {r('att_rate', 'value')} FROM ({compare})
            UNION ALL SELECT district, 'fln_score', {r('fln_score', 'value')} FROM ({compare})""",
        "filter_values": """SELECT DISTINCT 'district' AS filter, district AS value FROM school WHERE district IS NOT NULL
            UNION ALL SELECT DISTINCT 'school_type', school_type FROM school WHERE school_type IS NOT NULL""",
        "attendance_totals": """SELECT count(*) AS total, CAST(sum(is_impossible_attendance::INT) AS BIGINT) AS imp,
            CAST(sum(is_proxy_attendance::INT) AS BIGINT) AS proxy FROM attendance""",
        "monthly_trend": f"""SELECT month, {r('avg(avg_attendance_rate)', 'avg_attendance_rate')},
            {r('avg(proxy_anomaly_rate_pct)', 'proxy_anomaly_rate_pct')} FROM monthly WHERE month IS NOT NULL GROUP BY month""",
        "trend_by_district": f"""SELECT month, {r('avg(avg_attendance_rate)', 'avg_attendance_rate')} FROM monthly
            WHERE district = '{district}' GROUP BY month""",
        "proxy_top20": f"{daily} WHERE is_proxy_attendance {proxy_order.format('')} LIMIT 20",
        "proxy_by_district": f"{daily} WHERE is_proxy_attendance AND district = '{district}' {proxy_order.format('school_name, district, ')} LIMIT 10",
        "procurement_totals": f"""SELECT {r('sum(quantity_kg)', 'tot_kg')}, {r('sum(total_cost)', 'tot_cost')},
            {r('avg(cost_per_kg)', 'avg_cpk')} FROM procurement""",
        "vendor_ranking": f"SELECT vendor_name, {r('sum(total_cost)', 'total_cost')} FROM procurement GROUP BY vendor_name",
        "commodity_mix": f"""SELECT grain_type, {r('kg', 'total_kg')}, {r('kg * 100.0::DOUBLE / (SELECT sum(quantity_kg) FROM procurement)', 'share_pct')}
            FROM (SELECT grain_type, sum(quantity_kg) AS kg FROM procurement GROUP BY grain_type)""",
        "vendor_spend_topn": f"""SELECT vendor_name, {r('sum(total_cost)', 'total_cost_rs')}, {r('sum(quantity_kg)', 'total_quantity_kg')}
            FROM procurement WHERE vendor_name IS NOT NULL GROUP BY vendor_name
            ORDER BY total_cost_rs DESC NULLS LAST, vendor_name LIMIT 3""",
        "amenity_share": "SELECT " + ", ".join(
            r(f"avg(CASE WHEN {a} THEN 1.0::DOUBLE ELSE 0.0 END) * 100", n)
            for a, n in zip(AMENITIES, ("elec", "water", "toilet", "wall", "play"))) + " FROM infra_current",
        "deficit_ranking": f"""SELECT district, {r('avg(infrastructure_deficit_pct)', 'deficit')}
            FROM infra_current i LEFT JOIN school s ON i.school_id = s.school_id GROUP BY district""",
        "score_totals": f"SELECT {r('avg(score_percentage)', 'avg_score')}, count(*) AS total_tests FROM scores",
        "score_by_subject": f"SELECT subject, {r('avg(score_percentage)', 'avg_score')} FROM scores GROUP BY subject",
        "score_by_grade": f"SELECT grade, {r('avg(score_percentage)', 'avg_score')} FROM scores GROUP BY grade",
        "score_by_amenity": f"""SELECT CASE WHEN has_electricity THEN 'Functional Electricity' ELSE 'No Functional Electricity' END
            AS electricity_status, {r('avg(score_percentage)', 'avg_fln_score')}
            FROM scores t JOIN infra_current i ON t.school_id = i.school_id WHERE has_electricity IS NOT NULL GROUP BY 1""",
        "district_score_ranking": f"""SELECT district, {r('avg(avg_fln_score)', 'avg_fln_score')} FROM district_kpis
            WHERE district IS NOT NULL GROUP BY district""",
        "district_overview": f"""SELECT district, {r('avg(avg_attendance_rate)', 'avg_attendance_rate')},
            {r('avg(avg_fln_score)', 'avg_fln_score')} FROM district_kpis WHERE district IS NOT NULL GROUP BY district""",
        "welfare_risk": risk_sql,
        "risk_distribution": f"""SELECT welfare_risk_category, count(*) AS school_count,
            {r('count(*) * 100.0::DOUBLE / (SELECT count(*) FROM risk)', 'share_pct')} FROM risk GROUP BY welfare_risk_category""",
        "risk_bands": """SELECT count(*) FILTER (welfare_risk_category = 'High Risk') AS high_risk,
            count(*) FILTER (welfare_risk_category = 'Moderate Risk') AS moderate_risk,
            count(*) FILTER (welfare_risk_category = 'Low Risk') AS low_risk FROM risk""",
        "risk_priority": priority_sql,
        "risk_priority_labelled": f"""SELECT school_id AS "School Identifier", school_name AS "School Name", district AS "District Name",
            block AS "Block Name", welfare_risk_score AS "Welfare & Retention Risk Index (0-100)",
            welfare_risk_category AS "Welfare Risk Classification",
            {r('avg_attendance_rate', '"Average Daily Attendance Rate (%)"')}, {r('avg_fln_score', '"Average FLN Test Score (%)"')},
            {r('infrastructure_deficit_pct', '"Infrastructure Deficit Index (%)"')} FROM risk""",
        "risk_topn": f"{priority_sql} LIMIT 10",
        "result_digest": f"""SELECT count(*) AS n_rows, (SELECT district FROM ov ORDER BY v DESC NULLS LAST, district LIMIT 1) AS max_entity,
            {r('max(v)', 'max_value')}, (SELECT district FROM ov ORDER BY v NULLS LAST, district LIMIT 1) AS min_entity,
            {r('min(v)', 'min_value')}, {r('avg(v)', 'mean_value')} FROM ov""",
        "score_trendline": f"""SELECT CAST(regr_count(avg_fln_score, avg_attendance_rate) AS BIGINT) AS n_points,
            {r('regr_slope(avg_fln_score, avg_attendance_rate)', 'slope')},
            {r('regr_intercept(avg_fln_score, avg_attendance_rate)', 'intercept')},
            {r('regr_r2(avg_fln_score, avg_attendance_rate)', 'r2')} FROM kpis""",
        "csv_round_trip": "SELECT * FROM raw_infra",
        "csv_by_heading": """SELECT record_id, school_id, date, grade, CAST(total_students AS DOUBLE) AS total_students,
            CAST(present_students AS DOUBLE) AS present_students, teacher_present, marked_by, shift, count(*) AS exact_copies
            FROM (SELECT *, unnest(['am', 'pm']) AS shift FROM raw_attendance) GROUP BY ALL""",
        "csv_counts": """SELECT * REPLACE (CASE total_enrolled_students % 4 WHEN 0 THEN total_enrolled_students + 0.5::DOUBLE
            WHEN 1 THEN NULL ELSE total_enrolled_students::DOUBLE END AS total_enrolled_students) FROM raw_school""",
        "json_array": "SELECT * FROM raw_scores",
        "json_round_trip": "SELECT * FROM raw_scores",
        "parquet_round_trip": "SELECT * FROM attendance",
        "workbook_scan": "SELECT * FROM raw_procurement",
        "workbook_files": r"""SELECT * EXCLUDE (k), strftime(DATE '1904-01-01' + CAST(1 + k % 30000 AS INT), '%Y-%m-%d 00:00:00') AS received,
            CASE WHEN k % 9 <> 0 THEN regexp_replace(CAST(k / 8.0::DOUBLE AS VARCHAR), '\.0$', '') END AS weight,
            CASE WHEN k % 3 = 0 THEN 'TRUE' ELSE 'FALSE' END AS checked, CAST(k AS VARCHAR) AS lot
            FROM (SELECT *, CAST(procurement_id[4:] AS BIGINT) AS k FROM raw_procurement)""",
        "risk_table_write": risk_sql,
        "risk_view": risk_sql,
        "risk_table_replaced": risk_sql,
        "rescue_run": " UNION ALL ".join(audit),
        "adhoc_sql": f"""SELECT block, count(*) AS records, {r('avg(attendance_rate)', 'avg_rate')} FROM daily
            WHERE data_quality_status = 'VALID' GROUP BY block""",
    }
    opened = {"vw_school_attendance_daily": "attendance_daily", "vw_school_attendance_monthly": "attendance_monthly",
              "vw_school_mdm_summary": "procurement_summary", "vw_school_infrastructure_summary": "infra_summary",
              "vw_school_test_summary": "test_summary", "vw_district_summary": "district_summary"}
    bodies["warehouse_open"] = " UNION ALL ".join(
        f"SELECT '{view}' AS relation, count(*) AS n_rows FROM ({bodies[name]})" for view, name in opened.items())
    twins = {name: twin(body) for name, body in bodies.items()}
    skewed = _raw_attendance("(CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE o_custkey END)")
    twins["attendance_daily_skewed"] = twin("SELECT * FROM daily", raw_attendance=skewed)
    twins |= {f"{name}_stored": twins[name] for name in stored} | {"district_summary_bucketed": twins["district_summary"]}

    def ranged(body, first=since, last=until):
        """The body over attendance of a range of days."""
        own = f"SELECT * FROM ({_TABLES['attendance']}) WHERE date BETWEEN DATE '{first}' AND DATE '{last}'"
        return twin(body, attendance=own)

    twins["monthly_trend_ranged"] = ranged(bodies["monthly_trend"])
    twins["trend_by_district_ranged"] = ranged(bodies["trend_by_district"], "1995-03-01", "1996-08-31")
    twins["attendance_totals_ranged"] = ranged(bodies["attendance_totals"])
    twins["proxy_ranged"] = ranged(bodies["proxy_top20"])
    twins["result_digest_chosen"] = twin(f"""SELECT count(*) AS n_rows, max_by(school_id, (v, -r)) AS max_entity, {r('max(v)', 'max_value')},
        min_by(school_id, (v, r)) AS min_entity, {r('min(v)', 'min_value')}, {r('avg(v)', 'mean_value')}
        FROM (SELECT school_id, welfare_risk_score AS v, row_number() OVER (ORDER BY school_id) AS r FROM risk)""")
    overview = ("SELECT district, avg(avg_attendance_rate) AS v FROM district_kpis WHERE district IS NOT NULL GROUP BY district")
    digest = twin(f"SELECT 1 FROM ({overview})").removesuffix(f"SELECT 1 FROM ({overview})")
    twins["result_digest"] = f"{digest.rstrip()}, ov AS ({overview}) {bodies['result_digest']}"
    return twins

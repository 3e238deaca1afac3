"""DuckDB SQL for the queries of the question-bank operators."""

from __future__ import annotations

from sondera.functions.text import CHINESE_MARKER, DIGIT_MARKER, FULL_WIDTH, HALF_WIDTH, PUNCTUATION, SPACE, TERMS
from sondera.functions.text import AD_PATTERNS
from sondera.operators.notes import BANK_MARK, COMPANY_KEYWORDS, DIRECTORY_PATTERNS, DIVE_ITEM, QUESTION_START
from sondera.plans import literals
from sondera.plans.bank import TOPICS


def lit(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, str):
        parts = []
        for piece in x.split("\n"):
            parts.append("'" + piece.replace("'", "''") + "'")
        return "(" + " || chr(10) || ".join(parts) + ")" if len(parts) > 1 else parts[0]
    return str(x)


def values(rows: list, columns: str) -> str:
    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) v({columns}))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def normalize(x: str) -> str:
    t = f"translate({x}, {lit(FULL_WIDTH)}, {lit(HALF_WIDTH)})"
    for a, b in PUNCTUATION:
        t = f"replace({t}, {lit(a)}, {lit(b)})"
    t = f"regexp_replace({t}, '{SPACE}+', ' ', 'g')"
    for a, b in TERMS:
        t = f"regexp_replace({t}, '(?i){a}', {lit(b)}, 'g')"
    return strip(t)


def key(x: str) -> str:
    return rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_]', '', 'g')"


def clean(x: str) -> str:
    t = f"regexp_replace(coalesce({x}, ''), '<[^>]+>', '', 'g')"
    for p in AD_PATTERNS:
        t = f"regexp_replace({t}, '(?i){p}', '', 'g')"
    t = f"regexp_replace({t}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return strip(f"array_to_string(list_transform(string_split({t}, chr(10)), lambda x: {strip('x')}), chr(10))")


TIER = "CASE WHEN {0} >= 20 THEN 3 WHEN {0} >= 10 THEN 2 WHEN {0} >= 5 THEN 1 ELSE 0 END"
TIER_LABEL = "CASE WHEN {0} >= 20 THEN '超高频' WHEN {0} >= 10 THEN '高频' WHEN {0} >= 5 THEN '中频' ELSE '' END"
LINES = f"""
split_ AS (SELECT doc_id, source, string_split(text, chr(10)) AS l FROM documents),
cut AS (SELECT doc_id, source, unnest(range(len(l))) AS pos, unnest(l) AS line FROM split_),
lines AS (SELECT doc_id * 1000000 + pos AS qid, doc_id AS record_id, source, {strip("line")} AS raw FROM cut WHERE {strip("line")} <> ''),
q AS (SELECT *, {normalize("raw")} AS norm FROM lines),
ql AS (SELECT *, lower(raw) AS exact_key, {key("coalesce(nullif(norm, ''), raw)")} AS norm_key FROM q)
"""
GROUPS = f"""{LINES},
g AS (
  SELECT {key("norm")} AS k, min(qid) AS label, arg_max(raw, (length(raw), -qid)) AS text, count(*) AS member_count,
    list_sort(list_distinct(list(source))) AS companies, list_slice(list_sort(list_distinct(list(raw))), 1, 10) AS variants
  FROM q GROUP BY 1)
"""


def _hits(column: str) -> str:
    parts = []
    for c, (_, words) in TOPICS.items():
        n = " + ".join(f"contains(lower(coalesce({column}, '')), {lit(w)})::INT" for w in words)
        parts.append(f"struct_pack(n := -({n}), c := {lit(c)})")
    return f"list_transform(list_sort(list_filter([{', '.join(parts)}], lambda x: x.n < 0)), lambda x: x.c)"


TAGGED = f"""{GROUPS},
t0 AS (SELECT *, len(companies) AS company_count, {_hits("text")} AS names FROM g),
tagged AS (SELECT *, coalesce(names[1], 'uncertain') AS primary_tag, names[2:4] AS secondary_tags FROM t0),
named AS (SELECT *, CASE primary_tag {' '.join(f"WHEN {lit(c)} THEN {lit(n)}" for c, (n, _) in TOPICS.items())} ELSE primary_tag END AS category FROM tagged),
exploded AS (SELECT *, unnest(companies) AS company FROM tagged)
"""
COSINES = """
e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
s AS (SELECT a.id AS a, b.id AS b, list_cosine_similarity(a.v, b.v) AS score FROM e a JOIN e b ON a.id <> b.id),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS n FROM s),
near AS (SELECT a, b, score FROM r WHERE n <= 8 AND a < b AND score >= 0.30)
"""
JUDGED = f"""{COSINES},
verdicts AS (SELECT a, b, score AS confidence, score >= 0.38 AS duplicate, score >= 0.38 AND score < 0.40 AS review FROM near),
links AS (SELECT a, b FROM verdicts WHERE confidence >= 0.40 UNION SELECT b, a FROM verdicts WHERE confidence >= 0.40)
"""
REACH = "reach(id, label) AS (SELECT id, id FROM e UNION SELECT links.b, reach.label FROM reach JOIN links ON reach.id = links.a), labels AS (SELECT id, min(label) AS label FROM reach GROUP BY id)"
CANONICAL = f"""
WITH RECURSIVE {JUDGED}, {REACH},
m AS (SELECT vec_id AS qid, 'question ' || (vec_id % 97) AS raw, 'r' || (vec_id % 7) AS record_id, 'round ' || embeddings.label AS hint, labels.label AS cluster FROM embeddings JOIN labels ON id = vec_id),
flagged AS (SELECT a AS qid FROM verdicts WHERE review UNION SELECT b FROM verdicts WHERE review),
c AS (
  SELECT cluster AS label, arg_max(raw, (length(raw), -m.qid)) AS text, count(*) AS member_count,
    array_to_string(list_sort(list(m.qid)), ',') AS member_ids, array_to_string(list_sort(list_distinct(list(hint))), ',') AS round_hints,
    array_to_string(list_slice(list_sort(list_distinct(list(raw))), 1, 10), ',') AS variants, array_to_string(list_sort(list(record_id)), ',') AS source_refs,
    bool_or(flagged.qid IS NOT NULL) AS in_review
  FROM m LEFT JOIN flagged USING (qid) GROUP BY 1)
SELECT label, text, member_count, member_ids, round_hints, variants, source_refs FROM c WHERE """


def _listed(t: str, marker: str) -> str:
    line = rf"regexp_extract(x, '^{marker}') || {strip(f'''regexp_replace(x, '^{marker}', '')''')}"
    return f"array_to_string(list_transform(string_split(regexp_replace({t}, '({marker})', chr(1) || '\\1', 'g'), chr(1))[2:], lambda x: {line}), chr(10))"


def _csv(x: str) -> str:
    t = f"replace(replace(regexp_replace({x}, '{SPACE}+', ' ', 'g'), '；', ';'), '：', ':')"
    return strip(f"CASE WHEN regexp_matches({t}, '{CHINESE_MARKER}') THEN {_listed(t, CHINESE_MARKER)} WHEN regexp_matches({t}, '{DIGIT_MARKER}') THEN {_listed(t, DIGIT_MARKER)} ELSE {t} END")


def _format(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '{BANK_MARK}') THEN 'knowledge_base' WHEN contains({c}, '游侠飞书剪存') OR contains({c}, '原文链接') THEN 'feishu' WHEN contains({c}, '2025年至今') AND contains({c}, '次**') THEN 'ali_deep_dive' WHEN contains({c}, '**发布时间**') THEN 'standard' ELSE 'general' END"


_FILES = values(literals.FILES, "id, path, content")
_KEY = "coalesce(" + ", ".join(f"nullif(regexp_extract(dir_name, '{p}', 1), '')" for p in DIRECTORY_PATTERNS) + ")"
_COMPANY = "CASE " + " ".join(f"WHEN {' OR '.join(f'contains(lower(text), {lit(w.lower())})' for w in words)} THEN {lit(name)}" for name, words in COMPANY_KEYWORDS) + " END"
_SENTENCES = rf"string_split(regexp_replace(coalesce(text, ''), '([。！？.!?]){SPACE}*', '\1' || chr(1), 'g'), chr(1))"


COMPANY_ROWS = f"""SELECT company, text AS question, {TIER_LABEL.format('member_count')} AS tier, primary_tag AS topic,
    coalesce(array_to_string(secondary_tags, ', '), '') AS secondary, member_count AS count, array_to_string(variants[1:3], '; ') AS variants FROM exploded"""
TOPIC_ROWS = f"""SELECT category, text AS question, {TIER_LABEL.format('member_count')} AS tier, member_count AS count, company_count,
    array_to_string(companies[1:5], ', ') AS companies, array_to_string(variants[1:3], '; ') AS variants, coalesce(array_to_string(secondary_tags, ', '), '') AS secondary FROM named"""
CANDIDATES = f"""
WITH {COSINES}, x AS (SELECT vec_id AS id, 'question ' || (vec_id % 97) AS raw FROM embeddings),
p AS (SELECT a.id AS a, b.id AS b, 1 AS layer FROM x a JOIN x b ON a.raw = b.raw AND a.id < b.id UNION ALL SELECT a, b, 2 FROM near)
SELECT a, b, CASE min(layer) WHEN 1 THEN 'exact' ELSE 'embedding' END AS source FROM p GROUP BY a, b"""


def report_lines(rows: str, section: int, lines: str, o1: str = "0", o2: str = "''", o3: str = "''", o4: str = "0") -> str:
    inner = f"SELECT {section}::BIGINT AS section, ({o1})::BIGINT AS o1, {o2} AS o2, {o3} AS o3, ({o4})::BIGINT AS o4, {lines} AS l FROM {rows}"
    return f"SELECT section, o1, o2, o3, o4, unnest(range(len(l)))::BIGINT AS line_no, unnest(l) AS line FROM ({inner})"


ICON = f"repeat('🔥', ({TIER.format('member_count')})::INT)"
_HIGH = "member_count >= 5"
_TIMES = f"CASE WHEN {_HIGH} THEN '**出现次数**: **' || member_count || '** (高频)' ELSE '**出现次数**: ' || member_count END"
_VARIANTS = "**常见变体**:"


def _title(level: str) -> str:
    return f"CASE WHEN {_HIGH} THEN '{level}' || rank || '. ' || {ICON} || ' ' || text ELSE '{level}' || rank || '. ' || text END"


def company_report() -> str:
    others = "list_transform(list_filter(variants[1:3], lambda v: v <> text), lambda v: '- ' || v)"
    item = f"list_concat([{_title('#### ')}, ''], CASE WHEN len(variants) > 0 THEN list_concat(['{_VARIANTS}'], {others}, ['']) ELSE [] END, [{_TIMES}, ''])"
    tag = "CASE WHEN tag = 'uncertain' THEN '待分类' ELSE tag END"
    parts = [
        report_lines("(SELECT count(*) AS n FROM tot)", 0, "['# AI算法工程师面经汇总 - 按公司分类', '', '共收录 ' || n || ' 家公司的面试问题', '', '---', '']"),
        report_lines("tot", 1, "['## ' || company, '', '**问题总数**: ' || questions || ' (高频 ' || high || ' 个)', '']", "-questions", "company"),
        report_lines("(SELECT DISTINCT company, questions, tag FROM r)", 1, f"['### ' || {tag}, '']", "-questions", "company", "chr(1) || tag"),
        report_lines("r", 1, item, "-questions", "company", "chr(1) || tag", "rank"),
        report_lines("tot", 1, "['---', '']", "-questions", "company", "chr(2)"),
    ]
    return f"""WITH {TAGGED}, tot AS (SELECT company, count(*) AS questions, count(*) FILTER ({_HIGH}) AS high FROM exploded GROUP BY 1),
        r AS (SELECT exploded.*, primary_tag AS tag, questions, high, row_number() OVER (PARTITION BY company, primary_tag ORDER BY member_count DESC, label) AS rank FROM exploded JOIN tot USING (company))
        {' UNION ALL '.join(parts)}"""


ORDERED = f"""cats AS (SELECT category, count(*) AS questions, count(*) FILTER ({_HIGH}) AS high FROM named GROUP BY 1),
    placed AS (SELECT *, row_number() OVER (ORDER BY questions DESC, category) AS place FROM cats)"""


def knowledge_report() -> str:
    seen = "'**出现公司**: ' || array_to_string(companies[1:5], ', ') || CASE WHEN len(companies) > 5 THEN ' 等' || len(companies) || '家公司' ELSE '' END"
    others = "list_filter(variants[1:5], lambda v: v <> text)"
    variants = f"CASE WHEN len({others}) > 0 THEN list_concat(['{_VARIANTS}'], list_transform(({others})[1:3], lambda v: '- ' || v), ['']) ELSE [] END"
    item = f"list_concat([{_title('### ')}, ''], CASE WHEN len(companies) > 0 THEN [{seen}, ''] ELSE [] END, [{_TIMES}, ''], {variants})"
    head = "['# AI算法工程师面经汇总 - 按知识点分类', '', '共收录 ' || q || ' 个问题', '涵盖 ' || c || ' 个知识点领域', '**高频问题（出现5次以上）: ' || h || ' 个**', '', '---', '', '## 高频问题速览', '']"
    parts = [
        report_lines("sums", 0, head),
        report_lines(f"(SELECT * FROM named WHERE {_HIGH} ORDER BY member_count DESC, label LIMIT 50)", 1, f"['- ' || {ICON} || ' **' || text || '** (' || member_count || '次 | ' || array_to_string(companies[1:3], ', ') || ')']", "-member_count", o4="label"),
        report_lines("sums", 2, "['', '---', '', '## 目录', '']"),
        report_lines("placed", 3, "['- [' || category || '](#' || lower(category) || ') (' || questions || '题' || CASE WHEN high > 0 THEN ' (' || high || '高频)' ELSE '' END || ')']", "place"),
        report_lines("sums", 4, "['', '---', '']"),
        report_lines("placed", 5, "['## ' || category, '', '**题目数量**: ' || questions || ' (高频 ' || high || ' 个)', '']", "place"),
        report_lines("r", 5, item, "place", o4="rank"),
        report_lines("placed", 5, "['---', '']", "place", "'end'"),
    ]
    return f"""WITH {TAGGED}, {ORDERED}, sums AS (SELECT sum(questions)::BIGINT AS q, count(*) AS c, sum(high)::BIGINT AS h FROM placed),
        r AS (SELECT named.*, place, row_number() OVER (PARTITION BY category ORDER BY member_count DESC, label) AS rank FROM named JOIN placed USING (category))
        {' UNION ALL '.join(parts)}"""


AUDITED = """r AS (SELECT DISTINCT doc_id FROM documents), l AS (SELECT DISTINCT doc_id FROM labels), missing AS (SELECT doc_id FROM r ANTI JOIN l USING (doc_id)),
    a AS (SELECT (SELECT count(*) FROM r) AS total_records, (SELECT count(*) FROM labels) AS total_questions, (SELECT count(*) FROM labels WHERE quality = 1) AS first_pass,
        (SELECT count(*) FROM labels WHERE quality IS DISTINCT FROM 1) AS coverage_pass, (SELECT count(*) FROM l) AS covered, (SELECT count(*) FROM l ANTI JOIN r USING (doc_id)) AS orphans,
        (SELECT count(*) FROM missing) AS failures, (SELECT count(*) FROM l) / (SELECT count(*) FROM r) AS rate,
        (SELECT count(*) FROM conversations) AS total_chunks, (SELECT count(*) FROM benchmark) AS canonical_questions)"""


def run_report() -> str:
    share = "printf('%.2f%%', rate * 100)"
    counts = [("原始面经记录", "total_records"), ("文本分块数", "total_chunks"), ("原子问题总数", "total_questions"), ("首次抽取问题数", "first_pass"), ("补漏抽取问题数", "coverage_pass"), ("去重后问题数", "canonical_questions")]
    listed = ", ".join(f"'| {label} | ' || {name} || ' |'" for label, name in counts)
    head = f"['# 面经处理流水线运行报告', '', '**运行ID**: ', '**开始时间**: ', '**结束时间**: ', '', '---', '', '## 数据统计', '', '| 指标 | 数量 |', '|------|------|', {listed}, '', '---', '', '## 覆盖率', '', '**源记录覆盖率**: ' || {share}, '']"
    state = f"CASE WHEN rate >= 1 THEN '- [x] 覆盖率 = 100%' ELSE '- [ ] 覆盖率 = ' || {share} || ' (目标100%)' END"
    errors = "(SELECT event_type AS status, count(*) AS n FROM events WHERE event_type <> 'ok' GROUP BY 1)"
    some = f"(SELECT count(*) AS n FROM {errors} HAVING count(*) > 0)"
    parts = [
        report_lines("a", 0, head),
        report_lines("(SELECT * FROM a WHERE failures > 0)", 1, "['### 未覆盖记录', '', '共 ' || failures || ' 条记录未抽取到问题：', '']"),
        report_lines("(SELECT * FROM missing ORDER BY doc_id LIMIT 10)", 2, "['- `' || doc_id || '`']", o2="lpad(doc_id::VARCHAR, 64, ' ')"),
        report_lines("(SELECT * FROM a WHERE failures > 0)", 3, "list_concat(CASE WHEN failures > 10 THEN ['- ... 还有 ' || (failures - 10) || ' 条'] ELSE [] END, [''])"),
        report_lines(some, 4, "['---', '', '## 错误统计', '']"),
        report_lines(errors, 5, "['- ' || status || ': ' || n]", o2="status"),
        report_lines(some, 6, "['']"),
        report_lines("a", 7, f"['---', '', '## 验收状态', '', {state}, '']"),
    ]
    return f"WITH {AUDITED} {' UNION ALL '.join(parts)}"


def chunk_fold() -> str:
    """The fold as a recursion over tokens: whole paragraphs (p), or the sentences (s) of paragraphs beyond the size."""
    size, overlap = 3000, 300
    tail_n = f"1 + len(list_filter(range(1, len(s.g)), lambda j: list_sum(list_transform(s.g[len(s.g) - j + 1:], lambda x: length(x) + 2)) + length(s.g[len(s.g) - j]) <= {overlap}))"
    whole = "array_to_string(s.g, chr(10) || chr(10))"
    return rf"""WITH RECURSIVE pars AS (
        SELECT doc_id, list_filter(list_transform(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)), lambda x: {strip('x')}), lambda x: x <> '') AS l FROM documents),
    p AS (SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS par FROM pars),
    cut AS (SELECT doc_id, pos, par, CASE WHEN length(par) > {size} THEN list_filter(list_transform(string_split(regexp_replace(par, '([。！？.!?])\s*', '\1' || chr(1), 'g'), chr(1)), lambda x: {strip('x')}), lambda x: x <> '') ELSE [par] END AS parts FROM p),
    tok AS (SELECT doc_id, pos, length(par) > {size} AS large, unnest(range(len(parts))) AS sub, unnest(parts) AS t, len(parts) AS n FROM cut),
    num AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos, sub) AS i, count(*) OVER (PARTITION BY doc_id) AS total FROM tok),
    run AS (
        SELECT doc_id, 0::BIGINT AS i, []::VARCHAR[] AS g, 0::BIGINT AS used, 0::BIGINT AS spot, ''::VARCHAR AS held, 0::BIGINT AS start, []::STRUCT(c VARCHAR, b BIGINT)[] AS out FROM (SELECT DISTINCT doc_id FROM num)
        UNION ALL
        SELECT doc_id, i, g,
            CASE WHEN kind = 'large' THEN 0 ELSE used END, spot, held, start, out
        FROM (
            SELECT s.doc_id, n.i, CASE WHEN n.large THEN 'large' ELSE 'small' END AS kind,
                CASE WHEN n.large THEN []::VARCHAR[] WHEN f.full_ THEN list_append(f.kept, n.t) ELSE list_append(s.g, n.t) END AS g,
                CASE WHEN f.full_ THEN (SELECT coalesce(sum(length(x) + 2), 0) FROM (SELECT unnest(f.kept) AS x)) + length(n.t) ELSE s.used + length(n.t) + 2 END::BIGINT AS used,
                CASE WHEN n.large AND n.sub = n.n - 1 THEN h.start2 + length(h.held2) - {overlap} WHEN n.large THEN h.at0 WHEN f.full_ THEN s.spot + greatest(0, length({whole}) - {overlap}) ELSE s.spot END AS spot,
                CASE WHEN n.large AND n.sub < n.n - 1 THEN h.held2 ELSE '' END AS held, CASE WHEN n.large THEN h.start2 ELSE 0 END AS start,
                CASE WHEN n.large THEN list_concat(list_concat(h.first_, h.mid), CASE WHEN n.sub = n.n - 1 THEN [struct_pack(c := h.held2, b := h.start2)] ELSE [] END)
                     WHEN f.full_ THEN [struct_pack(c := {whole}, b := s.spot)] ELSE []::STRUCT(c VARCHAR, b BIGINT)[] END AS out
            FROM run s JOIN num n ON n.doc_id = s.doc_id AND n.i = s.i + 1,
            LATERAL (SELECT NOT n.large AND len(s.g) > 0 AND s.used + length(n.t) > {size} AS full_, s.g[greatest(1, len(s.g) - ({tail_n}) + 1):] AS kept) f,
            LATERAL (SELECT CASE WHEN n.sub = 0 AND len(s.g) > 0 THEN s.spot + length({whole}) - {overlap} ELSE s.spot END AS at0,
                CASE WHEN n.sub = 0 AND len(s.g) > 0 THEN [struct_pack(c := {whole}, b := s.spot)] ELSE []::STRUCT(c VARCHAR, b BIGINT)[] END AS first_) k,
            LATERAL (SELECT k.at0, k.first_, CASE WHEN n.sub = 0 THEN '' ELSE s.held END AS held0, CASE WHEN n.sub = 0 THEN k.at0 ELSE s.start END AS start0) z,
            LATERAL (SELECT z.at0, z.first_, z.held0 <> '' AND length(z.held0) + length(n.t) > {size} AS over_) o,
            LATERAL (SELECT o.at0, o.first_, CASE WHEN o.over_ THEN right(z.held0, {overlap}) || n.t ELSE z.held0 || n.t END AS held2,
                CASE WHEN o.over_ THEN z.start0 + length(z.held0) - {overlap} ELSE z.start0 END AS start2,
                CASE WHEN o.over_ THEN [struct_pack(c := z.held0, b := z.start0)] ELSE []::STRUCT(c VARCHAR, b BIGINT)[] END AS mid) h)
    ),
    made AS (
        SELECT doc_id, i, 0 AS k, unnest(range(len(out))) AS m, unnest(out) AS x FROM run
        UNION ALL
        SELECT doc_id, run.i, 1, 0, struct_pack(c := array_to_string(g, chr(10) || chr(10)), b := spot) FROM run JOIN (SELECT doc_id, max(i) AS last FROM run GROUP BY 1) z USING (doc_id) WHERE run.i = last AND len(g) > 0)
    SELECT doc_id AS record_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i, k, m) - 1)::INTEGER AS chunk_index, x.b::INTEGER AS char_start, (x.b + length(x.c))::INTEGER AS char_end, x.c AS chunk_text FROM made"""


def json_repair() -> str:
    """Cleaning, three rounds of removing unfinished ends, cutting open strings, closing; texts here have no escaped quotes."""
    clean = r"regexp_replace(trim(regexp_replace(trim(answer), '(?i)^```(?:json)?\s*|\s*```$', '', 'g')), '(?s)^[^{]*(\{.*\})[^}]*$', '\1')"
    once = lambda x: rf"""regexp_replace(regexp_replace(regexp_replace({x}, ',\s*"[^"]*"\s*:\s*[^,}}\]]*$', ''), '"[^"]*"\s*:\s*[^,}}\]]*$', ''), ',\s*$', '')"""
    comma = lambda x: rf"regexp_replace({x}, ',\s*([}}\]])', '\1', 'g')"
    odd = lambda x: f"(length({x}) - length(replace({x}, '\"', ''))) % 2 = 1"
    bare = "open_"
    for _ in range(4):
        bare = rf"regexp_replace(regexp_replace({bare}, '\{{[^{{}}\[\]]*\}}', '', 'g'), '\[[^{{}}\[\]]*\]', '', 'g')"
    return rf"""WITH a AS (SELECT id, answer, {comma(clean)} AS cleaned FROM {values(literals.ANSWERS, 'id, answer')}),
        r1 AS (SELECT *, {once('cleaned')} AS t1 FROM a), r2 AS (SELECT *, {once('t1')} AS t2 FROM r1), r3 AS (SELECT *, {once('t2')} AS t3 FROM r2),
        u AS (SELECT *, CASE WHEN {odd('t3')} AND regexp_matches(t3, '.[}}\],]') THEN regexp_extract(t3, '(?s)^.*[}}\],]') ELSE t3 END AS t4 FROM r3),
        o AS (SELECT *, regexp_replace(t4, '"[^"]*"', '', 'g') AS open_ FROM u), d AS (SELECT *, regexp_replace({bare}, '[^{{\[]', '', 'g') AS left_ FROM o),
        f AS (SELECT id, answer, cleaned, {comma("t4 || CASE WHEN " + odd('t4') + " THEN '" + '"' + "' ELSE '' END || translate(reverse(left_), '{[', '}]')")} AS fixed FROM d)
        SELECT id, json(list_filter([answer, cleaned, fixed], lambda x: json_valid(x) AND json_type(CASE WHEN json_valid(x) THEN x ELSE 'null' END) = 'OBJECT')[1])::VARCHAR AS object FROM f"""


def more() -> dict[str, str]:
    pieces = r"list_filter(list_transform(regexp_extract_all(text, '[^\n?？]+[?？]?'), lambda x: " + strip("x") + r"), lambda x: regexp_matches(x, '^\s*(?:\d+[.、）)]\s*|[-*]\s*)?(?:.*[?？]$|(?:介绍一下|讲一下|说说|为什么|怎么|如何))|^\s*\d+[.、）)]\s*\S'))"
    found = f"c AS (SELECT conv_id || '-' || turn AS chunk_id, text, {pieces} AS values FROM conversations)"
    made = CANONICAL.rsplit("SELECT label, text", 1)[0]
    folded = chunk_fold()
    meta = "(starts_with(x, '#') OR contains(x, '发布时间') OR contains(x, '**标签**') OR starts_with(" + strip("x") + ", '**回复数**'))"
    content = f"(NOT {meta} AND {strip('x')} <> '' AND NOT starts_with(x, '**') AND NOT starts_with(x, '>'))"
    return {
        "chunk_fold": folded,
        "chunk_stats": f"WITH f AS ({folded}) SELECT count(DISTINCT record_id) AS records, count(*) AS chunks, max(chunk_index)::BIGINT AS last_index FROM f",
        "provider_extract": f"WITH {found} SELECT chunk_id, len(values)::BIGINT AS questions, 'rule' AS model, 'ok' AS status FROM c",
        "status_histogram": "SELECT 'ok' AS status, count(*) AS n FROM conversations",
        "coverage_pass": f"""WITH t AS (SELECT conv_id || '-' || turn AS chunk_id, list_filter(list_distinct(list_transform(string_split(text, chr(10)), lambda x: {strip('x')})), lambda x: x <> '') AS l FROM conversations),
            k AS (SELECT chunk_id, list_filter(l, lambda x: contains(x, ' the ')) AS first_, list_filter(l, lambda x: contains(x, ' that ') OR contains(x, ' der ')) AS again FROM t)
            SELECT chunk_id, len(list_filter(again, lambda x: NOT list_contains(first_, x)))::BIGINT AS questions FROM k WHERE len(first_) > 0""",
        "extract_stats": "SELECT (SELECT count(*) FROM conversations) AS total_chunks, count(*) FILTER (quality = 1) AS first_pass_count, count(*) FILTER (quality IS DISTINCT FROM 1) AS coverage_pass_count, count(*) AS total_questions FROM labels",
        "ingest_stats": "SELECT 'type' AS by, lang AS value, count(*) AS n FROM documents GROUP BY ALL UNION ALL SELECT 'company', coalesce(source, '未知'), count(*) FROM documents GROUP BY ALL UNION ALL SELECT 'records', '', count(*) FROM documents",
        "dedupe_stats": f"{made}, v AS (SELECT count(*) AS n FROM verdicts) SELECT (SELECT count(*) FROM embeddings) AS total_questions, (SELECT n FROM v) AS candidate_pairs, 0::BIGINT AS fast_path_pairs, (SELECT n FROM v) AS judged_pairs, count(*) FILTER (NOT in_review) AS canonical_count, count(*) FILTER (in_review) AS review_count FROM c",
        "audit_full": f"WITH {AUDITED} SELECT total_records, total_questions, first_pass, coverage_pass, covered, orphans, failures, round(rate, 6) AS coverage_rate, total_chunks, canonical_questions FROM a",
        "uncovered_head": f"WITH {AUDITED} SELECT * FROM (SELECT doc_id::VARCHAR AS record_id, NULL::BIGINT AS others FROM missing ORDER BY doc_id LIMIT 10) UNION ALL SELECT NULL, failures - 10 FROM a WHERE failures > 10",
        "category_order": f"WITH {TAGGED}, {ORDERED} SELECT category, questions, high AS high_frequency, place FROM placed",
        "company_group_sheets": f"WITH {TAGGED} SELECT company, row_number() OVER (ORDER BY company) AS place, substr(company, 1, 31) AS sheet FROM (SELECT DISTINCT company FROM exploded) QUALIFY place <= 20",
        "knowledge_group_sheets": f"""WITH {TAGGED}, o AS (SELECT category, row_number() OVER (ORDER BY {TIER.format('member_count')} DESC, member_count DESC, text, category) AS n FROM named), m AS (SELECT category, min(n) AS n FROM o GROUP BY 1)
            SELECT category, row_number() OVER (ORDER BY n) AS place, substr(category, 1, 31) AS sheet FROM m QUALIFY place <= 20""",
        "company_report": company_report(),
        "knowledge_report": knowledge_report(),
        "run_report": run_report(),
        "merged_repairs": f"""WITH {LINES}, s AS (SELECT conv_id, turn, string_split(text, chr(10)) AS l FROM conversations), c AS (SELECT conv_id, turn * 1000000 + unnest(range(len(l))) AS pos, unnest(l) AS line FROM s),
            u AS (SELECT record_id AS chunk_id, 0 AS run, qid AS pos, raw AS t FROM q UNION ALL SELECT conv_id, 1, pos, line FROM c), z AS (SELECT *, {strip('t')} AS k FROM u)
            SELECT chunk_id, pos, t AS question_text_raw FROM z WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY chunk_id, k ORDER BY run, pos) = 1""",
        "standard_body": f"""WITH f AS (SELECT id, string_split(content, chr(10)) AS l FROM {_FILES}), h AS (SELECT id, l, list_position(list_transform(l, lambda x: {content}), true) AS first FROM f),
            m AS (SELECT id, l, CASE WHEN first > 0 THEN l[1:first - 1] ELSE l END AS head FROM h), k AS (SELECT id, l, coalesce(list_max(list_transform(head, lambda x, i: CASE WHEN {meta} THEN i END)), 0) AS last FROM m)
            SELECT id, {strip("array_to_string(l[last + 1:], chr(10))")} AS body FROM k""",
        "bank_split": f"""WITH b AS (SELECT id, string_split(regexp_replace(content, '(?m)({QUESTION_START})', chr(1) || '\\1', 'g'), chr(1))[2:] AS l FROM {_FILES})
            SELECT id, unnest(range(len(l))) AS n, unnest(list_transform(l, lambda x: {strip('x')})) AS block FROM b""",
        "deep_dive_split": f"""WITH s AS (SELECT id, string_split(regexp_replace(content, '\\n##{SPACE}+', chr(1), 'g'), chr(1))[2:] AS l FROM {_FILES}), t AS (SELECT id, unnest(range(len(l))) AS section_no, unnest(l) AS section FROM s),
            i AS (SELECT id, section_no, {strip("string_split(section, chr(10))[1]")} AS section, regexp_extract_all(section, '{DIVE_ITEM}', 1) AS titles, regexp_extract_all(section, '{DIVE_ITEM}', 2) AS freqs FROM t),
            u AS (SELECT id, section, {strip("unnest(titles)")} AS title, unnest(freqs) AS frequency FROM i)
            SELECT id, section, title, coalesce(frequency, '') AS frequency FROM u WHERE length(title) > 3""",
        "json_repair": json_repair(),
        "json_validate": f"""WITH a AS {values(literals.TYPED_ANSWERS, 'id, kind, answer')}
            SELECT id, CASE kind WHEN 'judgement' THEN coalesce(json_type(answer, '$.is_duplicate') = 'BOOLEAN' AND json_type(answer, '$.confidence') IN ('DOUBLE', 'BIGINT', 'UBIGINT'), false)
            WHEN 'classification' THEN coalesce(json_type(answer, '$.primary_tag') = 'VARCHAR', false)
            ELSE coalesce(len(list_filter(json_extract(answer, '$.questions[*]'), lambda q: json_type(q, '$.question_text') IS NULL OR json_type(q, '$.evidence_span') IS NULL)) = 0, false) END AS valid FROM a""",
    }


def oracle_sql() -> dict[str, str]:
    return {
        "flagship_frequency": f"WITH {GROUPS} SELECT label, text, member_count, len(companies)::BIGINT AS source_count, ({TIER.format('member_count')})::BIGINT AS tier FROM g WHERE member_count >= 5 ORDER BY member_count DESC, label LIMIT 50",
        "normalize_text": f"WITH {LINES} SELECT qid, norm FROM q UNION ALL SELECT qid, {normalize('raw')} AS norm FROM {values(literals.TEXTS, 'qid, raw')}",
        "compare_key": f"WITH {LINES} SELECT qid, {key('raw')} AS key, exact_key AS exact FROM ql",
        "clean_html": f"SELECT page_id, {clean('html')} AS clean FROM pages",
        "csv_text_split": f"SELECT id, {_csv('cell')} AS listed FROM {values(literals.CELLS, 'id, cell')}",
        "detect_format": f"SELECT id, {_format('content')} AS format FROM (SELECT id, content FROM {_FILES} UNION ALL SELECT 1000 + page_id, html FROM pages)",
        "dispatch_parser": f"""SELECT id, CASE WHEN lower(path) LIKE '%.csv' THEN 'csv' WHEN lower(path) LIKE '%.xlsx' OR lower(path) LIKE '%.xls' THEN 'excel'
            WHEN path LIKE '%/04-interview/%' THEN 'knowledge_base' ELSE {_format('content')} END AS parser FROM {_FILES}""",
        "company_from_dir": f"""WITH d AS (SELECT *, {_KEY} AS k FROM {values(literals.DIRECTORIES, 'id, dir_name')}), m AS {values(literals.DIRECTORY_MAP, 'dir_key, company')}
            SELECT id, coalesce(a.company, b.company, k) AS company_hint FROM d LEFT JOIN m a ON a.dir_key = dir_name LEFT JOIN m b ON b.dir_key = k""",
        "alias_join": f"SELECT doc_id, source AS company_raw, coalesce(canonical, source) AS company_norm FROM documents LEFT JOIN {values(literals.ALIASES, 'company_raw, canonical')} ON company_raw = source",
        "company_from_content": f"SELECT doc_id, {_COMPANY} AS company FROM (SELECT doc_id, text FROM documents UNION ALL SELECT * FROM {values(literals.COMPANY_TEXTS, 'doc_id, text')})",
        "header_synonyms": "SELECT o_orderkey, coalesce(o_orderpriority, o_orderstatus) AS company, o_custkey::VARCHAR AS questions, NULL::VARCHAR AS role FROM orders",
        "sentence_split": f"""WITH s AS (SELECT doc_id, list_filter(list_transform({_SENTENCES}, lambda x: {strip('x')}), lambda x: x <> '') AS l FROM documents)
            SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS sentence FROM s""",
        "paragraph_split": f"""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)), lambda x: {strip('x')}), lambda x: x <> '') AS l FROM documents)
            SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS paragraph FROM s""",
        "rule_extract": f"""WITH s AS (SELECT conv_id, turn, string_split(text, chr(10)) AS l FROM conversations), r AS (SELECT conv_id, turn, unnest(range(len(l))) AS pos, unnest(l) AS line FROM s), z AS (SELECT *, {strip('line')} AS q FROM r)
            SELECT conv_id, turn, pos, CASE WHEN turn = 0 THEN 'main' ELSE 'followup' END AS question_type,
            regexp_matches(q, '[?？]$') OR regexp_matches(q, '^(介绍一下|讲一下|说说|为什么|怎么|如何)') OR regexp_matches(q, '^\\p{{Nd}}+[.、）)]{SPACE}*[^\\s]') AS is_question FROM z WHERE q <> ''""",
        "keep_first_dedupe": f"WITH {LINES} SELECT qid, raw FROM (SELECT *, row_number() OVER (PARTITION BY record_id, raw ORDER BY qid) AS n FROM q) WHERE n = 1",
        "exact_pairs": f"WITH {LINES} SELECT a.qid AS a, b.qid AS b FROM ql a JOIN ql b ON a.exact_key = b.exact_key AND a.qid < b.qid",
        "normalized_pairs": f"WITH {LINES} SELECT a.qid AS a, b.qid AS b FROM ql a JOIN ql b ON a.norm_key = b.norm_key AND a.qid < b.qid",
        "exact_pair_count": f"WITH {LINES}, n AS (SELECT count(*) AS n FROM ql GROUP BY exact_key) SELECT sum(n * (n - 1) // 2)::BIGINT AS pairs FROM n",
        "tf_cosine_pairs": """WITH w AS (SELECT doc_id AS id, unnest(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')) AS token FROM documents),
            c AS (SELECT id, token, count(*) AS n FROM w GROUP BY 1, 2), k AS (SELECT id, sqrt(sum(n * n)::DOUBLE) AS norm FROM c GROUP BY 1),
            u AS (SELECT c.id, token, n / norm AS w FROM c JOIN k USING (id)), p AS (SELECT x.id AS a, y.id AS b, sum(x.w * y.w) AS s FROM u x JOIN u y ON x.token = y.token AND x.id < y.id GROUP BY 1, 2)
            SELECT a, b, round(s, 6) AS cosine FROM p WHERE s >= 0.95""",
        "vector_topk": f"WITH {COSINES} SELECT a, b, round(score, 6) AS score FROM near",
        "candidate_layers": CANDIDATES,
        "fast_path_verdicts": f"""WITH {LINES}, p AS (SELECT a.qid AS a, b.qid AS b, a.raw AS ra, b.raw AS rb, a.exact_key = b.exact_key AS same FROM ql a JOIN ql b ON (a.norm_key = b.norm_key OR a.exact_key = b.exact_key) AND a.qid < b.qid)
            SELECT a, b, CASE WHEN same THEN 'exact' ELSE 'normalized' END AS source, CASE WHEN same THEN 0.99 ELSE 0.97 END::DOUBLE AS confidence, greatest(length(ra), length(rb))::BIGINT AS hint_chars, false AS review FROM p""",
        "review_band": f"WITH {JUDGED} SELECT a, b, round(confidence, 6) AS confidence, duplicate, review FROM verdicts",
        "vector_components": f"WITH RECURSIVE {JUDGED}, {REACH} SELECT id, label FROM labels",
        "line_components": f"WITH {LINES} SELECT qid AS id, min(qid) OVER (PARTITION BY norm_key) AS label FROM ql",
        "canonical": CANONICAL + "NOT in_review",
        "review_queue": CANONICAL + "in_review",
        "keyword_classify": f"WITH t AS (SELECT doc_id, {_hits('text')} AS names FROM documents) SELECT doc_id, coalesce(names[1], 'uncertain') AS primary_tag, coalesce(array_to_string(names[2:4], ','), '') AS secondary_tags FROM t",
        "tag_stats": f"WITH t AS (SELECT {_hits('text')} AS names FROM documents) SELECT coalesce(names[1], 'uncertain') AS primary_tag, count(*) AS n FROM t GROUP BY 1",
        "company_rollup": f"WITH {GROUPS}, x AS (SELECT *, unnest(companies) AS company FROM g) SELECT company, count(*) AS questions, count(*) FILTER (member_count >= 5) AS high_frequency FROM x GROUP BY 1",
        "company_tag_rank": f"WITH {TAGGED}, n AS (SELECT *, row_number() OVER (PARTITION BY company, primary_tag ORDER BY member_count DESC, label) AS rank FROM exploded) SELECT company, primary_tag AS tag, rank, label, member_count FROM n",
        "company_sheet": f"WITH {TAGGED} {COMPANY_ROWS}",
        "knowledge_rollup": f"WITH {TAGGED} SELECT coalesce(category, 'ALL') AS category, count(*) AS questions, count(*) FILTER (member_count >= 5) AS high_frequency FROM named GROUP BY ROLLUP (category)",
        "knowledge_rank": f"WITH {TAGGED}, n AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY member_count DESC, label) AS rank FROM named) SELECT category, rank, label, member_count, company_count FROM n",
        "knowledge_sheet": f"WITH {TAGGED} {TOPIC_ROWS}",
        "coverage_audit": """WITH r AS (SELECT DISTINCT doc_id FROM documents), l AS (SELECT DISTINCT doc_id FROM labels)
            SELECT (SELECT count(*) FROM r) AS total_records, (SELECT count(*) FROM labels) AS total_questions, (SELECT count(*) FROM labels WHERE quality = 1) AS first_pass,
            (SELECT count(*) FROM labels WHERE quality IS DISTINCT FROM 1) AS coverage_pass, (SELECT count(*) FROM l) AS covered, (SELECT count(*) FROM l ANTI JOIN r USING (doc_id)) AS orphans,
            (SELECT count(*) FROM r ANTI JOIN l USING (doc_id)) AS failures, round((SELECT count(*) FROM l) / (SELECT count(*) FROM r), 6) AS coverage_rate""",
        "uncovered_records": "SELECT DISTINCT doc_id AS record_id FROM documents ANTI JOIN labels USING (doc_id)",
        "json_recover": "SELECT event_id, json(props)::VARCHAR AS props FROM events",
        "excel_sanitize": r"SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g') AS safe FROM documents",
    } | more()

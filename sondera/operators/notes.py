"""Format detection and the parsers of notes, as projections over (path, content)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondera.functions.text import SPACE, blank, clean_text, extract, strip, tags

# Constant companies and fallbacks.
BANK_COMPANY, DEEP_DIVE_COMPANY, UNKNOWN = "通用题库", "阿里巴巴", "未知"

# Companies and the keywords that name them; the first that occurs wins.
COMPANY_KEYWORDS = [
    ("字节跳动", ["字节跳动", "字节", "bytedance", "抖音", "tiktok"]),
    ("阿里巴巴", ["阿里巴巴", "阿里", "alibaba", "阿里云", "达摩院"]),
    ("腾讯", ["腾讯", "tencent", "微信", "QQ"]),
    ("美团", ["美团", "meituan"]),
    ("快手", ["快手", "kuaishou"]),
    ("百度", ["百度", "baidu"]),
    ("网易", ["网易", "netease", "网易云音乐", "网易游戏"]),
    ("小红书", ["小红书", "xiaohongshu", "xhs"]),
    ("华为", ["华为", "huawei"]),
    ("京东", ["京东", "jd", "jingdong"]),
    ("拼多多", ["拼多多", "pdd", "pinduoduo"]),
    ("哔哩哔哩", ["哔哩哔哩", "bilibili", "B站", "b站"]),
]

# Company names looked for in the headings of clipped documents, in two passes.
HEADING_COMPANIES = ["阿里|字节|腾讯|美团|快手|百度|网易|小红书|华为|京东|拼多多|B站|小米", "蚂蚁|滴滴|携程|OPPO|VIVO|联想|荣耀|商汤|科大讯飞"]

# Patterns of the input formats.
BANK_MARK = r"(?s)Q\p{Nd}+[:.：].*?难度"
QUESTION_START = rf"(?:^|\n)(?:#{{1,4}}{SPACE}*)?(?:Q\p{{Nd}}+[:.：]|问题\p{{Nd}}+[:.：]|####{SPACE}*Q\p{{Nd}}+)"
QUESTION_TITLE = rf"(?d)(?:Q\p{{Nd}}+[:.：]|问题\p{{Nd}}+[:.：]){SPACE}*(.+?)(?:\n|\z)"
DIFFICULTY = rf"(?d)\*\*难度\*\*[：:]{SPACE}*(.+?)(?:\n|\z)"
TAGS = rf"(?d)\*\*标签\*\*[：:]{SPACE}*(.+?)(?:\n|\z)"
DATES = [rf"(?d)\*\*发布时间\*\*[：:]{SPACE}*(.+?)(?:\n|\z)", rf"(?d)发布时间[：:]{SPACE}*(.+?)(?:\n|\z)", r"(\p{Nd}{4}[-/年]\p{Nd}{1,2}[-/月]\p{Nd}{1,2}日?)"]
DIVE_ITEM = rf"[-*]{SPACE}*\*\*([^*]+)\*\*[:：]?{SPACE}*(\p{{Nd}}+次)?"
CLIP_LINES = [rf"(?d)🔗{SPACE}*原文链接.*?\n", rf"(?d)⏰{SPACE}*剪存时间.*?\n", rf"(?d)✂️{SPACE}*本文档由.*?\n", rf"(?d)💖{SPACE}*更多好物.*?\n"]
DIRECTORY_PATTERNS = ["^nowcoder_(.+)_suanfa", "^(.+)_suanfa", "^(.+)_algorithm"]
CONTEXT_CHARS = 500


def detect_format(content: Column) -> Column:
    """knowledge_base, feishu, ali_deep_dive, standard or general; the first that fits. Unreadable (null) is general."""
    has = lambda s: F.contains(content, F.lit(s))
    return (
        F.when(content.rlike(BANK_MARK), "knowledge_base")
        .when(has("游侠飞书剪存") | has("原文链接"), "feishu")
        .when(has("2025年至今") & has("次**"), "ali_deep_dive")
        .when(has("**发布时间**"), "standard")
        .otherwise("general")
    )


def parser_of(path: Column, content: Column) -> Column:
    """Which parser takes a file: by suffix, then by its folder, then by its format."""
    suffix = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    parent = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    kind = detect_format(content)
    return (
        F.when(suffix == ".csv", "csv")
        .when(suffix.isin(".xlsx", ".xls"), "excel")
        .when(suffix == ".md", F.when((kind == "knowledge_base") | (parent == "04-interview"), "knowledge_base").otherwise(kind))
    )


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def company_of_content(content: Column) -> Column:
    """The first company with a keyword in the text, ignoring case; null without one."""
    low = F.lower(content)
    found = lambda words: reduce(lambda a, b: a | b, [F.contains(low, F.lit(w.lower())) for w in words])
    return F.coalesce(*[F.when(found(words), F.lit(name)) for name, words in COMPANY_KEYWORDS])


def directory_key(name: Column) -> Column:
    return F.coalesce(*[extract(name, p) for p in DIRECTORY_PATTERNS])


def with_directory_company(files: DataFrame, directories: DataFrame, name: str = "dir_name") -> DataFrame:
    """Add company_hint: the mapped directory, else the mapped or plain key inside its name, else null. The dimension is small."""
    d = F.broadcast(directories)
    exact = d.select(F.col("dir_key").alias(name), F.col("company").alias("_exact"))
    keyed = d.select(F.col("dir_key").alias("_key"), F.col("company").alias("_by_key"))
    out = files.join(exact, name, "left").withColumn("_key", directory_key(F.col(name))).join(keyed, "_key", "left")
    return out.withColumn("company_hint", F.coalesce("_exact", "_by_key", "_key")).drop("_exact", "_key", "_by_key")


def with_company_norm(records: DataFrame, aliases: DataFrame) -> DataFrame:
    """Add company_norm: the canonical name of company_raw, else company_raw itself."""
    out = records.join(F.broadcast(aliases), "company_raw", "left")
    return out.withColumn("company_norm", F.coalesce("canonical", "company_raw")).drop("canonical")


def heading(content: Column, levels: str) -> Column:
    return strip(extract(content, rf"(?dm)^{levels}{SPACE}+(.+)$"))


def standard_body(content: Column) -> Column:
    """The text after the last line of title, date or tags that comes before the first line of content."""
    line = F.split(content, "\n", -1)
    is_meta = lambda x: x.startswith("#") | F.contains(x, F.lit("发布时间")) | F.contains(x, F.lit("**标签**")) | strip(x).startswith("**回复数**")
    is_content = lambda x: ~is_meta(x) & (strip(x) != "") & ~x.startswith("**") & ~x.startswith(">")
    first = F.array_position(F.transform(line, is_content), True)
    head = F.when(first > 0, F.slice(line, F.lit(1), (first - 1).cast("int"))).otherwise(line)
    last = F.coalesce(F.array_max(F.transform(head, lambda x, i: F.when(is_meta(x), i + 1))), F.lit(0))
    return strip(F.array_join(F.slice(line, last + 1, F.size(line)), "\n"))


def parse_standard(files: DataFrame) -> DataFrame:
    """One record per non-blank note (path, content, company_hint)."""
    c = F.col("content")
    title = F.coalesce(heading(c, "#"), stem(F.col("path")))
    date = F.coalesce(*[strip(extract(c, p)) for p in DATES])
    return files.filter(~blank("content")).select(
        "path", title.alias("source_title"), F.col("company_hint").alias("company_raw"), date.alias("interview_date_raw"),
        c.alias("text_raw"), clean_text(standard_body(c)).alias("text_clean"), F.lit("standard_markdown").alias("parser"), F.lit(0).alias("ordinal"),
    )


def bank_blocks(content: Column) -> Column:
    """Question blocks in order; text before the first goes. Without questions the array is empty."""
    marked = F.regexp_replace(content, f"(?m)({QUESTION_START})", "\u0001$1")
    parts = F.split(marked, "\u0001", -1)
    return F.transform(F.slice(parts, 2, F.size(parts)), strip)


def parse_bank(files: DataFrame) -> DataFrame:
    """One record per question, or the whole file if it has none."""
    parts = files.select("path", "content", bank_blocks(F.col("content")).alias("blocks"))
    many = parts.filter(F.size("blocks") > 0).select("path", F.posexplode("blocks").alias("n", "text_raw"))
    many = many.select(
        "path", F.coalesce(strip(extract("text_raw", QUESTION_TITLE)), F.concat(F.lit("问题"), (F.col("n") + 1).cast("string"))).alias("source_title"),
        F.lit(BANK_COMPANY).alias("company_raw"), "text_raw", clean_text("text_raw").alias("text_clean"), F.lit("knowledge_base_markdown").alias("parser"),
        strip(extract("text_raw", DIFFICULTY)).alias("difficulty"), tags(extract("text_raw", TAGS)).alias("tags"), (F.col("n") + 1).alias("ordinal"),
    )
    whole = parts.filter(F.size("blocks") == 0).select(
        "path", stem(F.col("path")).alias("source_title"), F.lit(BANK_COMPANY).alias("company_raw"), F.col("content").alias("text_raw"),
        clean_text("content").alias("text_clean"), F.lit("knowledge_base_markdown").alias("parser"), F.lit(0).alias("ordinal"),
    )
    return many.unionByName(whole, allowMissingColumns=True)


def parse_clipped(files: DataFrame) -> DataFrame:
    """One record per clipped document."""
    c = F.col("content")
    head = extract(c, rf"(?dm)^#+{SPACE}*(.+?)(?:面经|面试)")
    company = F.coalesce(*[extract(head, f"({names})") for names in HEADING_COMPANIES], F.lit(UNKNOWN))
    text = reduce(lambda t, p: F.regexp_replace(t, p, ""), CLIP_LINES, clean_text(c))
    return files.select("path", stem(F.col("path")).alias("source_title"), company.alias("company_raw"), c.alias("text_raw"), strip(text).alias("text_clean"), F.lit("feishu_markdown").alias("parser"), F.lit(0).alias("ordinal"))


def parse_deep_dive(files: DataFrame) -> DataFrame:
    """One record per bold list item of each second-level section whose title has more than 3 characters."""
    sections = F.split("content", rf"\n##{SPACE}+", -1)
    s = files.select("path", F.posexplode(F.slice(sections, 2, F.size(sections))).alias("section_no", "section_text"))
    item = f"(?m){DIVE_ITEM}"
    s = s.withColumn("found", F.arrays_zip(
        F.regexp_extract_all("section_text", F.lit(item), F.lit(1)).alias("title"), F.regexp_extract_all("section_text", F.lit(item), F.lit(2)).alias("frequency"),
        F.slice(F.split("section_text", item, -1), 2, 1_000_000_000).alias("after")))
    rows = s.select("path", "section_no", strip(F.element_at(F.split("section_text", "\n", -1), 1)).alias("section"), F.posexplode("found").alias("item_no", "item"))
    title, frequency = strip(F.col("item.title")), F.coalesce("item.frequency", F.lit(""))
    context = F.substring(strip(F.col("item.after")), 1, CONTEXT_CHARS)
    text = F.concat(title, F.when(frequency != "", F.concat(F.lit(" ("), frequency, F.lit(")"))).otherwise(""), F.when(context != "", F.concat(F.lit("\n\n"), context)).otherwise(""))
    return rows.filter(F.length(title) > 3).select(
        "path", title.alias("source_title"), F.lit(DEEP_DIVE_COMPANY).alias("company_raw"), text.alias("text_raw"), text.alias("text_clean"), F.lit("ali_deep_dive").alias("parser"),
        "section", frequency.alias("frequency"), (F.col("section_no") * 1_000_000 + F.col("item_no")).alias("ordinal"),
    )


def parse_general(files: DataFrame) -> DataFrame:
    """One record per non-blank file."""
    c = F.col("content")
    return files.filter(~blank("content")).select(
        "path", F.coalesce(heading(c, "#+"), stem(F.col("path"))).alias("source_title"), F.coalesce(company_of_content(c), F.lit(UNKNOWN)).alias("company_raw"),
        c.alias("text_raw"), strip(c).alias("text_clean"), F.lit("general_markdown").alias("parser"), F.lit(0).alias("ordinal"),
    )


PARSERS = {"standard": parse_standard, "knowledge_base": parse_bank, "feishu": parse_clipped, "ali_deep_dive": parse_deep_dive, "general": parse_general}


def parse_notes(files: DataFrame) -> DataFrame:
    """Records of all notes (path, content, company_hint) by their parsers."""
    typed = files.withColumn("_parser", parser_of(F.col("path"), F.col("content")))
    parts = [parse(typed.filter(F.col("_parser") == name)) for name, parse in PARSERS.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# Column names that stand for each field of a table of questions.
SYNONYMS = {
    "company": ["公司名称", "公司", "company"],
    "role": ["岗位方向", "岗位", "role", "职位"],
    "round": ["面试轮次", "轮次", "round"],
    "date": ["面试时间", "时间", "date", "日期"],
    "questions": ["核心面试问题", "面试问题", "问题", "questions"],
    "result": ["面试结果", "结果", "result"],
}
EXCEL_SYNONYMS = SYNONYMS | {"questions": ["核心面试问题", "面试问题", "问题", "内容", "questions"]}


def bind_headers(rows: DataFrame, synonyms: dict[str, list[str]] | None = None) -> DataFrame:
    """Add one string column _<field> per field: the first present and non-null synonym, or null."""
    fields = SYNONYMS if synonyms is None else synonyms
    value = lambda names: F.coalesce(F.lit(None).cast("string"), *[F.col(f"`{n}`").cast("string") for n in names if n in rows.columns])
    return rows.withColumns({f"_{field}": value(names) for field, names in fields.items()})


def parse_table(rows: DataFrame, parser: str = "csv", synonyms: dict[str, list[str]] | None = None) -> DataFrame:
    """One record per row that has questions."""
    from sondera.functions.text import clean_csv_text

    bound = bind_headers(rows, synonyms).filter(F.length("_questions") > 0)
    text = F.concat_ws("\n\n", F.when(F.length("_round") > 0, F.concat(F.lit("面试轮次: "), F.col("_round"))), F.concat(F.lit("面试问题:\n"), F.col("_questions")))
    name = lambda c, other: F.when(F.length(c) > 0, F.col(c)).otherwise(other)
    return bound.select(
        "path", F.concat_ws("-", name("_company", "未知公司"), name("_role", "面试")).alias("source_title"), F.col("_company").alias("company_raw"), F.col("_role").alias("role_raw"),
        F.col("_date").alias("interview_date_raw"), text.alias("text_raw"), clean_csv_text(text).alias("text_clean"), F.lit(parser).alias("parser"),
        F.col("_round").alias("round"), F.col("_result").alias("result"), F.col("row_index").alias("ordinal"),
    )

"""Small inputs that show what the driver tables lack: wide characters, note formats, broken JSON."""

TEXTS = [(-1, "什么是ＢＮ？"), (-2, "a，b：c"), (-3, "讲一下【RoPE】。"), (-4, "  Batch　Norm \n和Layer norm "), (-5, "batch normalization的作用"), (-6, "自注意力机制"), (-7, "多头注意力机制"), (-8, "「引」『号』")]
CELLS = [
    (1, "面试轮次: 一面\n\n面试问题:\n1. 什么是BN 2. LN呢"),
    (2, "面试问题:\n一：自我介绍 二：项目"),
    (3, "面试问题:\nBN和LN"),
    (4, "面试问题:\n讲 v1.2 的区别"),
    (5, "甲；乙：丙"),
]
FILES = [
    (1, "/notes/nowcoder_bytedance_suanfa/a.md", "# 标题\n**发布时间**: 2024-01-02\n**标签**: x\n正文一\n正文二"),
    (2, "/notes/bank/b.md", "前言\n#### Q1: 什么是BN\n**难度**: 中\n**标签**: #归一化 #基础\n内容\n#### Q2：LN呢\n**难度**: 易\n完"),
    (3, "/notes/else/c.md", "# 字节面经\n🔗 原文链接: x\n⏰ 剪存时间: y\n问题一\n"),
    (4, "/notes/ali/d.md", "2025年至今\n## 位置编码\n- **RoPE 原理** 42次\n说明\n- **ab**\n* **42次**\n- **KV Cache**: 3次\n"),
    (5, "/notes/misc/e.md", "## 面试记录\n在腾讯面试"),
    (6, "/notes/04-interview/f.md", "没有题号的文件"),
    (7, "/notes/t/g.csv", ""),
    (8, "/notes/t/h.XLSX", ""),
    (9, "/notes/misc/blank.md", " \n　\n"),
]
DIRECTORIES = [(1, "nowcoder_bytedance_suanfa"), (2, "foo_suanfa"), (3, "04-interview"), (4, "misc"), (5, "alibaba"), (6, "tencent_algorithm")]
DIRECTORY_MAP = [("bytedance", "字节跳动"), ("alibaba", "阿里巴巴"), ("tencent", "腾讯"), ("04-interview", "通用题库")]
ALIASES = [("src0", "Source Zero"), ("src1", "Source One"), ("src2", "Source One"), ("SRC3", "never")]
COMPANY_TEXTS = [(-1, "在抖音和腾讯"), (-2, "QQ 音乐"), (-3, "无"), (-4, "BiliBili"), (-5, "Huawei 与 baidu")]
NEAR_TEXTS = [(200_001, "BN和LN的区别", ""), (200_002, "BN与LN的区别", ""), (200_003, "abcdefghij", ""), (200_004, "abcdefghijk", ""), (200_005, "kitten", ""), (200_006, "sitting", "")]
ANSWERS = [
    (1, '```json {"a":[1,2,],}```'),
    (2, 'text {"a": 1} more'),
    (3, '{"questions": [{"q": "BN"}, {"q": "L'),
    (4, "none"),
    (5, '{"a": "x", "b": '),
    (6, '{"a":1}'),
    (7, "[1, 2]"),
]
TYPED_ANSWERS = [
    (1, "judgement", '{"is_duplicate": true, "confidence": 0.9}'),
    (2, "judgement", '{"is_duplicate": true}'),
    (3, "judgement", '{"is_duplicate": "perhaps", "confidence": 0.9}'),
    (4, "classification", '{"primary_tag": "norm", "secondary_tags": ["a"]}'),
    (5, "classification", '{"secondary_tags": ["a"]}'),
    (6, "extraction", '{"questions": [{"question_text": "BN", "evidence_span": "BN?"}]}'),
    (7, "extraction", '{"questions": [{"question_text": "BN", "evidence_span": "BN?"}, {"question_text": "LN"}]}'),
    (8, "extraction", '{"questions": []}'),
]

"""Numbers, answers and kinds in the text of exam papers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions.text import SPACE, best_score, count_of, find_all, first_match, half_width, let, strip

# Patterns and word lists of the paper format.
QUESTION_NUMBER = r"^(\d{1,3})\s*[\.．。、\)）\]］:：]\s*"
# QUESTION_NUMBER of a line with blanks, heading marks, asterisks and backslashes about it, or nothing: a
# pattern that fails at the line's start would be tried at all of its places
LEADING_NUMBER = rf"(?U)^(?:[{SPACE}]*(?:#{{1,6}}\s*)?(?:\*\*+)?\\*(\d(?:\\*\d){{0,2}})[\\\s]*[\.．。、\)）\]］:：])?"
RANGE_ANSWER = r"(?<![\d.])(\d{1,3})\s*[–\-~—]\s*(\d{1,3})\s*([A-DＡ-Ｄ]{2,})"
INLINE_ANSWER = r"(?<![\d.])(\d{1,3})\s*\\?\.\s*([A-DＡ-Ｄ])(?![a-zA-Z\u4e00-\u9fff])"
ANSWER_LETTERS = "[A-DＡ-Ｄ]{1,4}"
GAOKAO_NAME = "高考[^，。；]{0,6}真题|真题汇编"
EXAM_KINDS = {
    "高考真题": ["高考真题", "真题汇编"],
    "合格考": ["合格考", "合格性考试", "合性试"],
    "会考": ["会考"],
    "学业水平考试": ["学业水平", "学考", "水平考试"],
    "等级考": ["等级考"],
    "竞赛自招": ["竞赛", "博雅", "强基", "自主招生", "领军", "筑梦"],
}
SUBJECTS = ["语文", "数学", "英语", "物理", "化学", "生物", "历史", "地理", "政治"]
COMBINED = {"文综": "文综", "理综": "理综", "理科综合": "理综", "文科综合": "文综"}
SUBJECT_WORDS = {
    "语文": ["阅读下面", "作文", "古诗文", "默写", "文言文"],
    "数学": ["函数", "方程", "数列", "概率", "几何", "导数", "不等式"],
    "英语": ["阅读理解", "完形填空", "作文", "单词", "听力"],
    "物理": ["受力", "加速度", "电路", "磁场", "动能", "折射"],
    "化学": ["化学", "离子", "溶液", "氧化还原", "有机", "元素周期"],
    "生物": ["细胞", "基因", "光合作用", "遗传", "DNA"],
    "历史": ["朝代", "历史", "封建", "革命", "近代化"],
    "地理": ["纬度", "气候", "地形", "洋流", "等高线"],
    "政治": ["政治", "经济制度", "哲学", "人民代表大会", "市场经济"],
}


def _contains_any(c: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w))
    return out


def leading_number(line: Column) -> Column:
    """The number at a line's start, whatever marks stand before it, or null. One match of the line as
    it is: only the number's own characters are rewritten."""
    whole = lambda n: F.when(n != "", let(F.replace(n, F.lit("\\"), F.lit("")), half_digits).cast("int"))
    return let(F.regexp_extract(line, LEADING_NUMBER, 1), whole)


def question_number(line: Column) -> Column:
    """The number at a line's start and what follows it: struct<n, rest>, or null."""
    s = F.regexp_replace(strip(line), r"(?U)^#{1,6}\s*", "")
    s = half_digits(F.replace(F.regexp_replace(s, r"^\*\*+", ""), F.lit("\\"), F.lit("")))
    n = leading_number(line)
    return F.when(n.isNotNull(), F.struct(n.alias("n"), F.regexp_replace(s, f"(?U){QUESTION_NUMBER}", "").alias("rest")))


def half_digits(c: Column) -> Column:
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(F.translate(c, "０１２３４５６７８９", "0123456789"))


def _first_of(entries: Column) -> Column:
    """Map of array<struct<n, value>> in which the first entry of a number holds."""
    first = lambda es, k: F.filter(es, lambda e: e["n"] == k)[0]["value"]
    told = lambda es: let(F.array_distinct(F.transform(es, lambda e: e["n"])), lambda keys: F.map_from_arrays(keys, F.transform(keys, lambda k: first(es, k))))
    return let(entries, told)  # bound, so that the text is parsed once and not for each number


def range_answers(text: Column) -> Column:
    """``1-5 ACDBA`` as map<int, string>; a range must have a letter a number."""
    part = lambda x, g: F.regexp_extract(x, RANGE_ANSWER, g)
    dashed = F.lit(False)
    for dash in "–-~—":
        dashed = dashed | F.contains(text, F.lit(dash))
    found = F.when(dashed, find_all(text, RANGE_ANSWER)).when(text.isNotNull(), F.array().cast("array<string>"))  # the text is searched once, its hits are parted
    rows = F.transform(found, lambda x: F.struct(part(x, 1).alias("lo"), part(x, 2).alias("hi"), part(x, 3).alias("letters")))
    rows = F.filter(rows, lambda r: (r["hi"].cast("int") > r["lo"].cast("int")) & (F.char_length(r["letters"]) == r["hi"].cast("int") - r["lo"].cast("int") + 1))
    each = F.transform(rows, lambda r: F.transform(F.sequence(r["lo"].cast("int"), r["hi"].cast("int")), lambda n: F.struct(n.alias("n"), half_width(F.substr(r["letters"], n - r["lo"].cast("int") + 1, F.lit(1))).alias("value"))))
    return _first_of(F.flatten(each))


def inline_answers(lines: Column) -> Column:
    """``21. B 22. C`` in lines that have two such pairs or more, as map<int, string>."""

    def pairs(line: Column) -> Column:
        got = F.arrays_zip(find_all(line, INLINE_ANSWER, 1).alias("n"), find_all(line, INLINE_ANSWER, 2).alias("value"))
        return let(got, lambda g: F.when(F.size(g) >= 2, F.transform(g, lambda p: F.struct(p["n"].cast("int").alias("n"), half_width(p["value"]).alias("value")))))

    return _first_of(F.flatten(F.array_compact(F.transform(lines, pairs))))


def _cells(row: Column) -> Column:
    return F.transform(find_all(row, r"(?s)<td[^>]*>(.*?)</td>", 1), lambda c: strip(F.regexp_replace(c, "<[^>]+>", "")))


def table_answers(text: Column) -> Column:
    """HTML tables whose row of numbers stands over a row of letters, as map<int, string>; the
    last entry of a number holds."""
    tables = F.when(F.contains(text, F.lit("<table")), find_all(text, r"(?s)<table[^>]*>(.*?)</table>", 1)).when(text.isNotNull(), F.array().cast("array<string>"))
    rows = F.transform(tables, lambda t: F.transform(find_all(t, r"(?s)<tr[^>]*>(.*?)</tr>", 1), _cells))

    def paired(rs: Column) -> Column:
        def pair(a: Column, i: Column) -> Column:
            b = F.get(rs, i + 1)
            fits = (F.size(a) >= 3) & (F.size(a) == F.size(b)) & F.forall(a, lambda c: c.rlike(r"(?U)^\d*$")) & F.forall(b, lambda c: c.rlike(f"^({ANSWER_LETTERS})?$"))
            both = F.zip_with(a, b, lambda n, v: F.struct(n.try_cast("int").alias("n"), v.alias("value")))
            return F.when(F.coalesce(fits, F.lit(False)), F.filter(both, lambda p: p["n"].isNotNull() & (p["value"] != "")))

        return F.flatten(F.array_compact(F.transform(rs, pair)))

    return _first_of(F.reverse(F.flatten(F.transform(rows, paired))))


def keyed_cells(line: Column, numbers: Column) -> Column:
    """Cells of a one-line table for the given numbers: by the number each begins with, else by
    position; struct<method, answers, unresolved>. Nothing is guessed."""
    cells = F.transform(find_all(line, r"(?s)<td[^>]*>(.*?)</td>", 1), lambda c: strip(c))
    keys = F.transform(cells, lambda c: F.regexp_extract(c, r"^(\d{1,3})\s*[.、．]", 1))
    keyed = (F.size(cells) > 0) & F.forall(keys, lambda k: k != "")
    entries = F.reverse(F.zip_with(keys, cells, lambda k, c: F.struct(k.try_cast("int").alias("n"), c.alias("value"))))
    by_key = F.map_filter(_first_of(entries), lambda k, v: F.array_contains(numbers, k))
    by_place = F.when(F.size(cells) == F.size(numbers), F.map_from_arrays(numbers, cells)).otherwise(F.create_map().cast("map<int,string>"))
    answers = F.when(keyed, by_key).otherwise(by_place)
    return F.struct(F.when(keyed, "td_by_question_number").otherwise("td_positional").alias("method"), answers.alias("answers"), F.array_except(numbers, F.map_keys(answers)).alias("unresolved"))


def exam_kind(name: Column, text: Column) -> Column:
    """struct<kind, reason>: by name, else by ordered words in name and text."""
    rules = [("高考真题\t文件名", name.rlike(GAOKAO_NAME))]
    for kind, words in EXAM_KINDS.items():
        rules += [(f"{kind}\t文件名", _contains_any(name, words)), (f"{kind}\t内容", _contains_any(F.concat(name, F.lit("\n"), text), words))]
    got = first_match(rules, "其他汇编\t未判定")
    return F.struct(F.substring_index(got, "\t", 1).alias("kind"), F.substring_index(got, "\t", -1).alias("reason"))


def subject(name: Column, parent: Column, text: Column, otherwise: str = "未分类") -> Column:
    """struct<subject, reason>: combined papers, the name, the folder, the text's words."""
    scores = {s: sum((count_of(text, w) for w in words), F.lit(0)) for s, words in SUBJECT_WORDS.items()}
    by_name = first_match([(s, F.contains(name, F.lit(k))) for k, s in COMBINED.items()])
    plain = first_match([(s, F.contains(name, F.lit(s))) for s in SUBJECTS])
    folder = F.when(parent.isin(SUBJECTS), parent)
    content = best_score(scores, 3)
    told = lambda c, why: F.when(c.isNotNull(), F.struct(c.alias("subject"), F.lit(why).alias("reason")))
    return F.coalesce(told(by_name, "文件名(综合卷)"), told(plain, "文件名"), told(folder, "父目录"), told(content, "内容推断"), F.struct(F.lit(otherwise).alias("subject"), F.lit("未判定").alias("reason")))


def lint(text: Column, lines: Column) -> Column:
    """Counts of what would not render: odd dollars, chemistry and broken commands, tables and
    divs that do not balance, doubled quotes."""
    odd = lambda ln: (F.regexp_count(ln, F.lit(r"(?<!\\)\$")) % 2 == 1) & ~F.contains(ln, F.lit("$$"))
    where = lambda f: F.array_compact(F.transform(lines, lambda ln, i: F.when(f(ln), i + 1)))
    uneven = lambda tag, pat: F.when(count_of(text, rf"(?i)<{pat}\b") != count_of(text, rf"(?i)</{pat}>"), F.lit(tag))
    return F.struct(
        where(odd).alias("dollar_odd"),
        F.size(F.filter(lines, lambda ln: ln.rlike(r"\\ce\s*\{"))).alias("ce"),
        where(lambda ln: ln.rlike(r"\\(\d|[\u4e00-\u9fff])")).alias("bad_command"),
        F.array_compact(F.array(uneven("table", "table"), uneven("tr", "tr"), uneven("td", "(?:td|th)"))).alias("unbalanced"),
        count_of(text, r"\"\"\s*/?>").alias("bad_attr"),
        where(lambda ln: F.regexp_count(ln, F.lit(r"(?i)<div\b")) != F.regexp_count(ln, F.lit(r"(?i)</div>"))).alias("div"),
    )

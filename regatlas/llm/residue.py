"""Template residue, filler and error-page text."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut

# Marks of template languages around a name, and general marks of filler, of errors and of demands for scripts.
PLACEHOLDERS = [
    r"\{\{[^\n]*?\}\}", r"\{\{\s*[\w.\-]+", r"\{%[^%\n]+%\}", r"\$\{[\w.\- ]+\}", r"#\{[\w.\- ]+\}", r"<%=?[^%\n]+%>",
    r"\[\[\s*[A-Za-z][\w.\- ]*\]\]", r"<<\s*[A-Za-z][\w.\- ]*>>", r"@@[A-Za-z][\w.\-]*@@", r"(?<!\w)__[A-Za-z][\w.\-]*?[A-Za-z0-9]__(?!\w)",
    r"(?<![\w%])%[A-Za-z][\w.\-]*%(?!\w)", r"<(?i:enter|insert|your|add|type|replace|fill in)\b[^>\n]+>", r"<[^<>\n]+ (?i:goes here|here)>",
    r"\[(?i:enter|insert|your|add|type|fill in)\b[^\]\n]+\]", r"\[[^\[\]\n]+ (?i:goes here|here)\]",
]
FILLER = [
    r"lorem ipsum", r"dolor sit amet", r"\bx{2,}(?: x{2,}){3,}", r"(?:text|content|title|description|heading) (?:goes |comes )?here\b", r"placeholder text", r"dummy text",
    r"^\W*(?:asdf|qwerty)\b", r"hier (?:steht|kommt) (?:ihr|der) text", r"此处(?:填写|插入|输入)", r"示例文本",
]
ERRORS = [
    r"(?:http|error|status|code)\s*:?\s*[45]\d\d\s*(?:[-–:.!]|the\b|$)", r"^\W*[45]\d\d\b\s*[-–:.]?\s*(?:page |file |error|not |forbidden|unauthori[sz]ed|bad |service |gateway|internal |too many|gone)",
    r"^\W*http(?:/\S+)?\s+[45]\d\d\b", r"^\W*not found\s*(?:[.!]|$)", r"^\W*(?:your )?request (?:was |has been )?(?:blocked|denied)\b", r"server (?:did|does|is) not (?:answer|respond)", r"link (?:may|might) be (?:old|broken|outdated|wrong)",
    r"(?:page|file|document|site|content) (?:is gone|has (?:been )?(?:moved|removed|deleted)|was (?:moved|removed|deleted))\b",
    r"(?:page|file|document|url|address|site|resource|content) (?:was |could |can |is )?(?:not|no longer) (?:be )?(?:found|available|exist)\w*\s*(?:[.!,;:(|]|$|in your)",
    r"^\W*access (?:is |was )?denied\s*(?:[.!:,]|$)", r"permission to (?:view|access|open|read)", r"^\W*forbidden\s*(?:[.!:]|$)", r"(?:service|server|site|portal) (?:is )?(?:temporarily |currently )?(?:unavailable|overloaded)",
    r"bad gateway", r"gateway time-?out", r"internal server error", r"too many requests", r"for maintenance\s*(?:[.!]|$)", r"try again (?:later|in \d)", r"(?:session|login) (?:has |is )?(?:expired|timed out)",
    r"(?:sign|log) in again", r"connection (?:was|has been) (?:reset|refused|closed|lost)", r"something went wrong", r"^\W*(?:oops|sorry)\b", r"failed to load\s*(?:[.!]|$)", r"could not (?:load|display|render)\b",
    r"^\W*(?:fatal|unexpected|unhandled|runtime) (?:error|exception)\b\s*:", r"^\W*traceback\b", r"\bplease wait\b", r"checking your browser", r"not a robot", r"captcha",
    r"(?:seite|datei) (?:wurde |konnte )?nicht gefunden", r"zugriff verweigert", r"nicht (?:erreichbar|verfügbar)\s*(?:[.!]|$)", r"bitte warten", r"sitzung (?:ist )?abgelaufen",
    r"страница не найдена", r"доступ (?:запрещ|закрыт)", r"сервис недоступен", r"(?:页面|网页|文件)(?:不存在|未找到|无法)", r"找不到.{0,4}(?:页面|网页)", r"访问被拒绝|拒绝访问", r"服务器?.{0,6}(?:不可用|内部错误)", r"(?:登录|会话)已?(?:过期|失效)",
    r"请稍[候后]", r"重新登录",
]
SCRIPTS = [
    r"(?:enable|activate|allow|accept|turn on) (?:all )?(?:java ?script|cookies|scripts)\b", r"(?:java ?script|cookies|scripts?|active content)(?: support)? (?:is|are|must be) (?:disabled|required|enabled|blocked|(?:turned|switched) o(?:ff|n))",
    r"(?:needs|requires) (?:java ?script|cookies|scripts)\s*(?:[.!,]|$)", r"browser does not support", r"^\W*noscript\b", r"(?:skripte|java ?script|cookies) (?:werden )?(?:benötigt|deaktiviert)", r"aktivieren sie (?:java ?script|cookies)",
    r"(?:启用|开启|需要)\s*(?:java ?script|cookie|脚本)", r"включите (?:java ?script|cookies)",
]
# Literals of which at least one stands in whatever a pattern above matches; cheap to look for.
PLACEHOLDER_SIGNS = ["{{", "{%", "${", "#{", "<", "[", "@@", "__", "%"]
FILLER_SIGNS = ["lorem ipsum", "dolor sit", "xx xx", " here", "placeholder text", "dummy text", "asdf", "qwerty", "hier steht", "hier kommt", "此处", "示例文本"]
NOTICE_SIGNS = [
    *(f"{word}{gap}{digit}" for word in ("http", "error", "status", "code") for gap in ("", " ", ":", ": ") for digit in "45"),
    "not found", "not be found", "not available", "not be available", "not exist", "no longer found", "no longer available", "no longer exist", "access denied", "access is denied", "access was denied", "permission to", "forbidden",
    "unauthori", "unavailable", "overloaded", "gateway", "server error", "request blocked", "request was", "request denied", "request has been", "server did", "server does", "server is not", "link may be", "link might be", "is gone", "has moved", "has been moved", "has been removed",
    "has been deleted", "has removed", "has deleted", "was moved", "was removed", "was deleted", "too many requests", "for maintenance", "try again", "expired", "has timed out", "is timed out", "session timed", "login timed", "in again", "connection was", "connection has been",
    "went wrong", "oops", "sorry", "failed to load", "could not load", "could not display", "could not render", "fatal e", "unexpected e", "unhandled e", "runtime e", "traceback", "please wait", "your browser", "a robot", "captcha",
    "nicht gefunden", "nicht erreichbar", "nicht verfügbar", "verweigert", "bitte warten", "abgelaufen", "не найдена", "доступ ", "недоступен", "不存在", "未找到", "无法", "找不到", "拒绝", "不可用", "内部错误", "过期", "失效", "请稍", "重新登录",
    "javascript", "java script", "cookie", "scripts", "script is", "script support", "active content", "does not support", "noscript", "skripte", "脚本",
]
# End of fixed values.

#: Texts of a host that must hold a line for it to recur; share of the host's texts, and share of these that must be sound beside it, for it to be boilerplate.
RECURS, HOST_SHARE, SOUND_SHARE = 3, 0.01, 0.5
#: Texts that must hold a sentence, and share of them that must be notices, for it to be learnt as one; times to learn.
LEARN_TEXTS, LEARN_SHARE, LEARN_ROUNDS = 3, 0.5, 2
#: Share of the words of a text's sentences that evidence must have.
EVIDENCE_SHARE = 1 / 6
#: Words of a filler line; share of them that must be filler words; share of a word's lines that must hold open filler.
FILLER_WORDS, FILLER_SHARE, FILLER_LEARN = 8, 0.8, 0.2
#: Sentences of a line of which at most half are different that make it filler.
PARROTED = 4


def without_code(text: Column) -> Column:
    """``text`` without fenced listings (an open fence reaches to the end) and inline code."""
    fenced = F.regexp_replace(text, r"(?s)(?:```.*?(?:```|\z)|~~~.*?(?:~~~|\z))", "\n")
    return F.when(text.contains("`") | text.contains("~~~"), F.regexp_replace(fenced, r"`[^`\n]+`", " ")).otherwise(text)


def _any(text: Column, patterns: list[str]) -> Column:
    return F.coalesce(text.rlike("|".join(f"(?:{p})" for p in patterns)), F.lit(False))


@F.pandas_udf(T.IntegerType())
def _signs(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Which kinds of signs stand in a text: 1 placeholder, 2 filler, 4 notice; one pass of a multi-pattern automaton."""
    import ahocorasick

    kinds: dict[str, int] = {}
    for kind, signs in ((1, PLACEHOLDER_SIGNS), (2, FILLER_SIGNS), (4, NOTICE_SIGNS)):
        for sign in signs:
            kinds[sign] = kinds.get(sign, 0) | kind
    trie = ahocorasick.Automaton()
    for sign, kind in kinds.items():
        trie.add_word(sign, kind)
    trie.make_automaton()

    def one(text: str) -> int:
        bits = 0
        for _, kind in trie.iter(text.lower()):
            bits |= kind
        return bits

    for texts in it:
        yield texts.map(one, na_action="ignore").fillna(0).astype("int32")


def _unquoted(text: Column) -> Column:
    """Sentences without what they only quote."""
    return F.regexp_replace(text, r"(?<!\w)'[^'\n]*'(?!\w)|\"[^\"\n]*\"|“[^”\n]*”|„[^“”\n]*[“”]|「[^」\n]*」", " ' ' ")


def _word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\p{IsHan}{1,2}|[\p{L}_&&[^\p{IsHan}]][\p{L}\p{N}_&&[^\p{IsHan}]]*"))


def _line_hash(line: Column) -> Column:
    """Hash of a line without letter case, the amount of blanks, numbers and names (capitals, digits, underscores in a row)."""
    return F.xxhash64(F.trim(F.lower(F.regexp_replace(F.regexp_replace(line, r"\p{Nd}+|[\p{Lu}_][\p{Lu}\p{Nd}_]+", "0"), r"(?U)[\s&&[^ ]]+|\s{2,}", " "))))


def _lines(docs: DataFrame, *keep: str) -> DataFrame:
    """``docs`` with one row for each ``line`` that isn't blank."""
    return docs.select(*keep, F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(r"(?U)\S"))


def host_lines(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines counted by host: ``(source, line_hash, text_key)`` of the boilerplate without its text_key, and ``text_key`` of the bare texts.

    A line recurs when RECURS texts of its host hold it; a text is bare when at least half of it is such lines. A line is
    boilerplate when HOST_SHARE of its host's texts hold it and SOUND_SHARE of these aren't bare: what stands beside sound
    text everywhere. Copies of a text count as one. Only hashes and lengths are shuffled.
    """
    lines = _lines(docs, "text_key", "source").select("text_key", "source", _line_hash(F.col("line")).alias("line_hash"), F.length("line").alias("chars"))
    held = cut(lines.groupBy("source", "text_key", "line_hash").agg(F.sum("chars").alias("chars")))
    counted = held.groupBy("source", "line_hash").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= RECURS)
    again = cut(held.join(counted, ["source", "line_hash"]))
    sizes = docs.select("source", "text_key", F.length("text").alias("size")).distinct()
    full = again.groupBy("source", "text_key").agg(F.sum("chars").alias("again"))
    bare = cut(full.join(sizes, ["source", "text_key"]).where(F.col("again") * 2 >= F.col("size")).select("source", "text_key", F.lit(True).alias("bare")))
    hosts = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("host_texts"))
    often = again.join(hosts, "source").where(F.col("texts") >= F.col("host_texts") * HOST_SHARE)
    beside = often.join(bare, ["source", "text_key"], "left").groupBy("source", "line_hash").agg(F.avg(F.when(F.col("bare"), 0.0).otherwise(1.0)).alias("sound"))
    return beside.where(F.col("sound") >= SOUND_SHARE).select("source", "line_hash"), bare


def filler_lines(docs: DataFrame) -> DataFrame:
    """``(text_key, source, line_hash)`` of lines that are filler by their words: FILLER_WORDS or more of them, and either the
    same sentence again and again, or nearly all of them filler words.

    Only lines without digits, underscores, capitals in a row and other scripts can be the latter. Filler words are learnt from
    the corpus: at least FILLER_LEARN of the lines that hold one hold open filler (FILLER) too.
    """
    lines = _lines(docs, "text_key", "source").where(F.length("line") > 2 * FILLER_WORDS)
    sentences = F.filter(F.split("line", r"[.!?。！？]+\s*"), lambda s: s != "")
    parroted = lines.withColumn("sentences", sentences).where((F.size("sentences") >= PARROTED) & (2 * F.size(F.array_distinct("sentences")) <= F.size("sentences")))
    plain = lines.where(~F.col("line").rlike(r"[\d_]|\p{Lu}{2}|[^\p{IsLatin}\p{P}\s]")).where(_word_count(F.col("line")) >= FILLER_WORDS)
    own = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("line"), F.lit(r"(\p{L}+)"), 1)))
    each = cut(plain.select("text_key", "source", _line_hash(F.col("line")).alias("line_hash"), _any(F.lower("line"), FILLER).alias("open"), own.alias("word")).distinct())
    known = each.groupBy("word").agg(F.avg(F.col("open").cast("double")).alias("share")).where(F.col("share") >= FILLER_LEARN).select("word", F.lit(1).alias("known"))
    held = each.join(known, "word", "left").groupBy("text_key", "source", "line_hash").agg(F.count("known").alias("known"), F.count(F.lit(1)).alias("all"))
    worded = held.where(F.col("known") >= F.col("all") * FILLER_SHARE).select("text_key", "source", "line_hash")
    return worded.unionByName(parroted.select("text_key", "source", _line_hash(F.col("line")).alias("line_hash")))


def _notices(lines: DataFrame) -> DataFrame:
    """``text_key`` of the notices among ``lines(text_key, line, bare)``, the residual lines of texts that may be some.

    A sentence is evidence by a general mark, or because it is learnt: LEARN_SHARE of the bare texts that hold it are notices.
    A text is a notice when its evidence has EVIDENCE_SHARE of the words of its sentences; in a text that isn't bare, at least
    one sentence must be marked or all be learnt. Lines that hold no sentence's end are titles or navigation.
    """
    sentence = F.explode(F.filter(F.split(_unquoted(F.col("line")), r"(?<=[.!?。！？])\s*"), lambda s: s != ""))
    ended = F.col("line").rlike(r"[.!?。！？:：;；…]\W*$|[.!?。！？]\s")
    said = lines.select("text_key", "bare", ended.alias("prose"), sentence.alias("s")).select(
        "text_key", "bare", "prose", _line_hash(F.col("s")).alias("h"), F.col("s").rlike(r"[.!?。！？…]\W*$").alias("whole"), _any(F.lower("s"), ERRORS + SCRIPTS).alias("mark"), _word_count(F.col("s")).alias("words")
    )
    said = cut(said.withColumn("evidence", F.col("mark")))
    for _ in range(LEARN_ROUNDS):
        seen = said.where("bare").groupBy("text_key").agg(F.max("evidence").alias("notice"))
        shares = said.where("bare AND whole").select("text_key", "h").distinct().join(seen, "text_key").groupBy("h").agg(F.count(F.lit(1)).alias("texts"), F.avg(F.col("notice").cast("double")).alias("share"))
        learnt = shares.where((F.col("texts") >= LEARN_TEXTS) & (F.col("share") >= LEARN_SHARE)).select("h", F.lit(True).alias("learnt"))
        said = cut(said.join(learnt, "h", "left").withColumn("evidence", F.col("evidence") | F.coalesce("learnt", F.lit(False))).drop("learnt"))
    body = said.groupBy("text_key").agg(
        F.max("bare").alias("bare"), F.max("mark").alias("mark"), F.sum(F.when(F.col("evidence"), F.col("words")).otherwise(0)).alias("told"), F.sum(F.when(F.col("prose") & ~F.col("evidence"), F.col("words")).otherwise(0)).alias("other")
    )
    enough = (F.col("mark") | F.col("bare")) & (F.col("told") >= (F.col("told") + F.col("other")) * EVIDENCE_SHARE)
    return body.where((F.col("told") > 0) & (enough | (F.col("other") == 0))).select("text_key")


def residue(documents: DataFrame) -> DataFrame:
    """``(doc_id, reason)`` of documents to leave out: ``placeholder``, ``filler`` or ``notice`` (error page, waiting or
    access notice, demand for scripts).

    Normalised lines are counted by host first, the host's boilerplate is subtracted, and what is left is judged: outside code
    listings a template mark around a name is a placeholder and a line of filler is filler anywhere; a notice is a text with
    nothing much besides evidence, so sound texts that write about errors stay, and so do those with a banner that the host puts
    beside all its texts. Null and empty texts are never found; a null source is a host of its own; repeated rows count
    once; an empty table gives an empty result.

    Scale: lines are counted by hash; signs are sought once a text with one automaton, patterns only where a sign stands.
    """
    docs = documents.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.xxhash64("text").alias("text_key"), without_code(F.col("text")).alias("text")).where("text <> ''")
    furniture, bare = host_lines(docs)
    furniture = cut(furniture.withColumn("furniture", F.lit(True)))
    signed = docs.withColumn("signs", _signs("text")).join(bare, ["source", "text_key"], "left").where("signs > 0 OR bare").withColumn("bare", F.coalesce("bare", F.lit(False)))
    lines = _lines(signed, "doc_id", "source", "text_key", "signs", "bare").withColumn("line_hash", _line_hash(F.col("line")))
    left = lines.join(furniture, ["source", "line_hash"], "left").where("furniture IS NULL")
    bit = lambda kind: F.col("signs").bitwiseAND(F.lit(kind)) > 0
    judged = left.select(
        "doc_id", "source", "text_key", "line", F.when(bit(1), _any(F.col("line"), PLACEHOLDERS)).otherwise(False).alias("placeholder"), F.when(bit(2), _any(F.lower("line"), FILLER)).otherwise(False).alias("filler"),
        (F.col("bare") | bit(4)).alias("may"), "bare",
    )
    # a notice holds its evidence in a text that is bare or short of other sentences: texts without any marked line aren't split further
    marked = F.when(F.col("may"), _any(F.lower(_unquoted(F.col("line"))), [p.removeprefix(r"^\W*") for p in ERRORS + SCRIPTS])).otherwise(False)
    judged = cut(judged.withColumn("mark", marked).withColumn("line", F.when(F.col("may"), F.col("line"))))
    worded = filler_lines(docs).distinct().join(furniture, ["source", "line_hash"], "left_anti").select("source", "text_key").distinct()
    filler = judged.where("filler").select("doc_id").union(docs.select("doc_id", "source", "text_key").join(worded, ["source", "text_key"], "left_semi").select("doc_id"))
    may = judged.where("may").join(judged.where("mark").select("text_key").distinct().withColumn("told", F.lit(True)), "text_key", "left").where("bare OR told")
    found = _notices(may.select("text_key", "line", "bare").distinct())
    notice = judged.where("may").join(found, "text_key", "left_semi").select("doc_id")
    return (
        judged.where("placeholder").select("doc_id", F.lit("placeholder").alias("reason"))
        .union(filler.select("doc_id", F.lit("filler").alias("reason"))).union(notice.select("doc_id", F.lit("notice").alias("reason"))).distinct()
    )

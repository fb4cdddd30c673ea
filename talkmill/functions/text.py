"""Text expressions: words, lines, transcript lines, file names, ids, feed fields and rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as Unicode has it, with the separators that Java leaves out.
BLANK = "(?U)[\\s\\x1c-\\x1f\\x85]+"
#: Ends of lines, as in text files of any system.
LINE_END = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"
#: The forms of a transcript line, a transcript's file name and a chunk's id.
SEGMENT = "^\\[([^\\]]+)\\]\\s+([\\d.]+)s\\s+-\\s+(.*)"
FILE_NAME = "^(.+) - Episode (\\w+) - (\\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\\d|3[01])|Unknown Date)\\.txt$"
CHUNK_ID = "^(.*)-(\\d+)$"


def words(text: Column) -> Column:
    """The words of a text; none for null and blank ones."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{BLANK}|{BLANK}$", "")


def lines(text: Column) -> Column:
    return F.split(text, LINE_END)


def segments(transcripts: DataFrame, text_col: str = "text") -> DataFrame:
    """Transcripts to one row per line that reads `[speaker] 12.3s - text`: seq, speaker, start, text instead of the text. Headers (#), blank and malformed lines are passed over. The numbers of lines only order them; seq counts segments from 0 within each row's array."""
    line = lambda x: F.regexp_replace(x, f"^{BLANK}|{BLANK}$", "")
    kept = F.filter(F.transform(lines(F.col(text_col)), line), lambda x: x.rlike(SEGMENT) & ~x.startswith("#"))
    parsed = F.transform(kept, lambda x: F.struct(F.regexp_extract(x, SEGMENT, 1).alias("speaker"), F.regexp_extract(x, SEGMENT, 2).try_cast("double").alias("start"), F.regexp_extract(x, SEGMENT, 3).alias("text")))
    others = [F.col(c) for c in transcripts.columns if c != text_col]
    return transcripts.select(*others, F.posexplode(parsed).alias("seq", "s")).select(*others, "seq", "s.*")


def header(show: Column, number: Column, title: Column, date: Column) -> Column:
    return F.concat(F.lit("# "), show, F.lit(" - Episode "), number, F.lit("\n# "), title, F.lit("\n# Published: "), date, F.lit("\n\n"))


def title_of(text: Column) -> Column:
    """The first line that starts with "# " and names neither Episode nor Published, without the mark; empty if there is none."""
    found = F.filter(lines(text), lambda x: x.startswith("# ") & ~x.contains("Episode") & ~x.contains("Published"))
    return F.coalesce(F.regexp_replace(F.get(found, F.lit(0)), "^[# ]+", ""), F.lit(""))


def file_triple(name: Column) -> Column:
    """(show, episode_number, date) of a transcript's file name; null if it isn't one."""
    part = lambda i: F.regexp_extract(name, FILE_NAME, i)
    return F.when(name.rlike(FILE_NAME), F.struct(part(1).alias("show"), part(2).alias("episode_number"), part(3).alias("date")))


def file_name(show: Column, number: Column, date: Column) -> Column:
    return F.concat(show, F.lit(" - Episode "), number, F.lit(" - "), date, F.lit(".txt"))


def show_of(name: Column) -> Column:
    return F.substring_index(name, " - Episode ", 1)


def id_prefix(show: Column, number: Column, date: Column) -> Column:
    return F.replace(F.concat(show, F.lit("-ep"), number, F.lit("-"), date), F.lit(" "), F.lit("_"))


def chunk_id(prefix: Column, i: Column) -> Column:
    return F.concat_ws("-", prefix, i.cast("string"))


def id_suffix(id_: Column) -> Column:
    """What stands after the last hyphen; the whole id without one."""
    return F.substring_index(id_, "-", -1)


def id_index(id_: Column) -> Column:
    """The suffix as a number if it is digits, else null."""
    return F.when(id_suffix(id_).rlike("^[0-9]+$"), id_suffix(id_)).try_cast("long")


def date_number(date: Column) -> Column:
    """yyyymmdd; 0 for an unknown date."""
    return F.when(date == "Unknown Date", F.lit(0)).otherwise(F.replace(date, F.lit("-"), F.lit("")).try_cast("int"))


def feed_guid(guid: Column, is_link: Column) -> Column:
    """A feed's guid, unless it is empty or a link, which it is unless the feed says otherwise."""
    return F.when(F.coalesce(is_link, F.lit(True)) | guid.isNull() | (guid == ""), F.lit(None)).otherwise(guid)


def feed_number(itunes: Column, title: Column) -> Column:
    found = F.regexp_extract(F.coalesce(title, F.lit("")), "\\b[Ee]p\\.?\\s*(\\d+)", 1)
    return F.coalesce(F.nullif(itunes, F.lit("")), F.nullif(found, F.lit("")), F.lit("Unknown"))


def feed_date(published: Column) -> Column:
    """The day in the stamp's own zone."""
    day = F.try_to_timestamp(F.regexp_extract(published, "(\\d{1,2} \\w{3} \\d{4})", 1), F.lit("d MMM yyyy"))
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit("Unknown Date"))


def next_ingest(published: Column, hour: int = 9) -> Column:
    """The first daily run after a stamp; a stamp at the very hour waits a day."""
    today = F.date_trunc("DAY", published) + F.expr(f"INTERVAL {hour} HOURS")
    return F.when(today <= published, today + F.expr("INTERVAL 1 DAY")).otherwise(today)


def rewritten_header(text: Column, show: Column, old: Column, new: Column) -> Column:
    """text with the episode number of its first line changed, if that line is just the old header (a carriage return may follow)."""
    first = F.substring_index(text, "\n", 1)
    is_old = F.rtrim(first, F.lit("\r")) == F.concat(F.lit("# "), show, F.lit(" - Episode "), old)
    tail = F.substr(text, F.length(first) + 1)
    back = F.when(first.endswith("\r"), F.lit("\r")).otherwise(F.lit(""))
    return F.when(is_old, F.concat(F.lit("# "), show, F.lit(" - Episode "), new, back, tail)).otherwise(text)


def routes_to_second_tier(show: Column, text: Column, two_host: list[str], surnames: dict[str, list[str]]) -> Column:
    """Whether a show has two hosts, or a co-host's surname stands anywhere in the text."""
    named = F.lit(False)
    for name, listed in surnames.items():
        for surname in listed:
            named = named | ((show == name) & F.lower(text).contains(surname))
    return show.isin(two_host) | named


def is_cluster(label: Column) -> Column:
    return F.coalesce(label.startswith("SPEAKER_"), F.lit(False))


def is_non_episode(source: Column) -> Column:
    return F.coalesce(source != "podcast", F.lit(False))


def to_places(x: Column, digits: int) -> Column:
    """x, a double, rounded to this many digits by its exact binary value, halves to even. The product with the power of ten is kept as two doubles that lose nothing, so that its distance from a half has the right sign."""
    power = 10.0**digits
    wide = x * F.lit(134217729.0)
    high = wide - (wide - x)
    low = (x - high) * power
    k = F.rint(x * power)
    above, below = ((high * power - k) - 0.5) + low, ((high * power - k) + 0.5) + low
    odd = k % 2 != 0
    return F.when((above > 0) | ((above == 0) & odd), k + 1).when((below < 0) | ((below == 0) & odd), k - 1).otherwise(k) / power


def strip_speaker(text: Column, speaker: Column) -> Column:
    """The text without the mark of its speaker, where it starts with just that one."""
    mark = F.concat(F.lit("["), F.coalesce(F.nullif(speaker, F.lit("")), F.lit("UNKNOWN")), F.lit("] "))
    return F.when(F.startswith(text, mark), F.substr(text, F.length(mark) + 1)).otherwise(text)


def display_speaker(speaker_id: Column, name: Column, speaker: Column) -> Column:
    """The name that an id resolves to; else words that say the voice isn't identified, with id or cluster; empty values count as absent."""
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    voice = lambda c: F.concat(F.lit("unidentified voice ("), c, F.lit(")"))
    return F.when(some(speaker_id) & some(name), name).when(some(speaker_id), voice(speaker_id)).when(some(speaker) & (speaker != "UNKNOWN"), voice(speaker)).otherwise(F.lit("unidentified"))


def clip_parts(clip_id: Column) -> Column:
    """(stem, cluster, draw) of a clip's id stem--cluster--d0; null if it has other parts."""
    p = F.split(clip_id, "--")
    draw = F.regexp_extract(F.get(p, F.lit(2)), "^d(\\d+)$", 1).try_cast("long")
    return F.when((F.size(p) == 3) & draw.isNotNull(), F.struct(F.get(p, F.lit(0)).alias("stem"), F.get(p, F.lit(1)).alias("cluster"), draw.alias("draw")))

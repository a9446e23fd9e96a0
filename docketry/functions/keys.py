"""Natural keys, document types and codes of legislative records, as columns.

All functions take and return Columns. Where the value can't be had the result is null unless a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Document types as the chambers print them, with the code of each.
BILL_TYPES = {
    "S.": "S", "H.R.": "HR", "S.J.Res.": "SJRES", "H.J.Res.": "HJRES", "S.Res.": "SRES", "H.Res.": "HRES", "S.Con.Res.": "SCONRES", "H.Con.Res.": "HCONRES",
}
AMENDMENT_TYPES = {"S.Amdt.": "SAMDT", "H.Amdt.": "HAMDT"}
OTHER_DOCUMENTS = ("PN", "Treaty Doc.")
AMENDMENT_CODES = ("HAMDT", "SAMDT", "SUAMDT")
# The part of a public bill address for each bill type.
BILL_SLUGS = {
    "S": "senate-bill", "HR": "house-bill", "SJRES": "senate-joint-resolution", "HJRES": "house-joint-resolution",
    "SRES": "senate-resolution", "HRES": "house-resolution", "SCONRES": "senate-concurrent-resolution", "HCONRES": "house-concurrent-resolution",
}
# Text version names and their codes; the codes stand for themselves too.
VERSION_CODES = {
    "Introduced in House": "IH", "Introduced in Senate": "IS", "Reported in House": "RH", "Reported in Senate": "RS",
    "Referred in House": "RFH", "Referred in Senate": "RFS", "Engrossed in House": "EH", "Engrossed in Senate": "ES",
    "Engrossed Amendment House": "EAH", "Engrossed Amendment Senate": "EAS", "Enrolled Bill": "ENR",
    "Considered and Passed House": "CPH", "Considered and Passed Senate": "CPS", "Public Law": "PL", "Private Law": "PRL",
    "Public Print": "PP", "Printed as Passed": "PP", "Received in Senate": "RDS", "Received in House": "RDH",
    "Agreed to Senate": "ATS", "Agreed to House": "ATH", "Placed on Calendar Senate": "PCS", "Placed on Calendar House": "PCH",
    "Reported to Senate": "RTS", "Reported to House": "RTH", "Reference Change House": "RCH", "Reference Change Senate": "RCS",
    "Referral Instructions House": "RIH", "Referral Instructions Senate": "RIS", "Laid on Table in House": "LTH", "Laid on Table in Senate": "LTS",
}
AMENDMENT_VERSION_CODES = {"Submitted": "SUB", "Modified": "MOD"}
ROLES = ("Chairman", "Ranking Member", "Vice Chairman", "Member")
# How a vote's question begins, in the order in which they are tried.
VOTE_KINDS = (
    ("Committee", r"(?i)(?:reported favorably|ordered to be reported)"),
    ("Cloture", r"(?i)on (?:the )?cloture"),
    ("ConferenceReport", r"(?i)on agreeing to the conference report"),
    ("Amendment", r"(?i)on agreeing to the amendment"),
    ("Recommit", r"(?i)on (?:the )?motion to recommit"),
    ("VetoOverride", r"(?i)on overriding the veto"),
    ("Passage", r"(?i)on (?:passage|motion to suspend the rules and pass)"),
    ("Election", r"(?i)election of the speaker"),
)


def lookup(values: dict[str, str], c: Column) -> Column:
    """The value of a constant map, null if absent."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), c)


def matched(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null where there is no match, unlike regexp_extract."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def natural_key(congress: Column, kind: Column, number: Column) -> Column:
    """{congress}-{KIND}-{number}; null if a part is null."""
    return F.concat(congress.cast("string"), F.lit("-"), F.upper(kind), F.lit("-"), number.cast("string"))


def amendment_item_key(congress: Column, kind: Column, number: Column) -> Column:
    """Key of an amendment list item, whose type may be missing."""
    return natural_key(congress, F.coalesce(kind, F.lit("UNKNOWN")), number)


def vote_key(congress: Column, chamber: Column, session: Column, roll: Column, fallback_session: Column | None = None) -> Column:
    """{congress}-{chamber}-{session}-{roll}; a missing session takes the fallback."""
    s = session if fallback_session is None else F.coalesce(session, fallback_session)
    return F.concat(congress.cast("string"), F.lit("-"), chamber, F.lit("-"), s.cast("string"), F.lit("-"), roll.cast("string"))


def parse_key(key: Column) -> Column:
    """struct(congress int, kind, number, valid): at most three parts, the number keeping further dashes."""
    parts = F.split(key, "-", 3)
    congress = F.try_element_at(parts, F.lit(1)).try_cast("int")
    kind, number = F.try_element_at(parts, F.lit(2)), F.try_element_at(parts, F.lit(3))
    valid = F.coalesce((F.size(parts) == 3) & congress.isNotNull() & (kind != "") & (number != ""), F.lit(False))
    return F.struct(congress.alias("congress"), kind.alias("kind"), number.alias("number"), valid.alias("valid"))


def document_type(raw: Column) -> Column:
    """struct(class, code): class is bill, amendment, other or unknown; code is null but for bills and amendments."""
    c = F.trim(raw)
    code = F.coalesce(lookup(BILL_TYPES, c), lookup(AMENDMENT_TYPES, c))
    kind = F.when(c.isin(*BILL_TYPES), F.lit("bill")).when(c.isin(*AMENDMENT_TYPES), F.lit("amendment")).when(c.isin(*OTHER_DOCUMENTS), F.lit("other")).otherwise(F.lit("unknown"))
    return F.struct(kind.alias("class"), code.alias("code"))


def amendment_number(raw: Column) -> Column:
    """The digits of "S.Amdt. 123" and its kin; the whole text has to fit."""
    return matched(F.trim(raw), r"(?U)^(?:S\.U\.Amdt\.|S\.Amdt\.|H\.Amdt\.)\s+(\d+)$")


def amended_bill_key(raw: Column, congress: Column) -> Column:
    """Key of the bill that "H.R. 12" names; null unless a known bill type precedes a number."""
    c = F.trim(raw)
    prefix = F.regexp_replace(matched(c, r"(?U)^(.+?)\s+(\d+)$", 1), r"(?U)\s+", " ")
    return natural_key(congress, lookup(BILL_TYPES, prefix), matched(c, r"(?U)^(.+?)\s+(\d+)$", 2))


def bill_slug(code: Column) -> Column:
    return lookup(BILL_SLUGS, code)


def bill_url(congress: Column, code: Column, number: Column) -> Column:
    return F.concat(F.lit("https://www.congress.gov/bill/"), congress.cast("string"), F.lit("/"), bill_slug(code), F.lit("/"), number)


def classify_document(doc_type: Column, doc_congress: Column, doc_number: Column, amendment_no: Column, vote_congress: Column) -> Column:
    """What a vote was about: struct(legislation_type, bill_type, amendment_type, number, bill_key, amendment_key, url). A bill needs a congress
    above 0, an amendment a number that parses; else all fields are null."""
    t = document_type(doc_type)
    code, n = t["code"], amendment_number(amendment_no)
    is_bill = F.coalesce((t["class"] == "bill") & (doc_congress > 0), F.lit(False))
    is_amendment = F.coalesce((t["class"] == "amendment") & n.isNotNull(), F.lit(False))
    return F.struct(
        F.when(is_bill, F.lit("BILL")).when(is_amendment, F.lit("AMENDMENT")).alias("legislation_type"),
        F.when(is_bill, code).alias("bill_type"),
        F.when(is_amendment, code).alias("amendment_type"),
        F.when(is_bill, doc_number).when(is_amendment, n).alias("number"),
        F.when(is_bill, natural_key(doc_congress, code, doc_number)).alias("bill_key"),
        F.when(is_amendment, natural_key(vote_congress, code, n)).alias("amendment_key"),
        F.when(is_bill, bill_url(doc_congress, code, doc_number)).alias("url"),
    )


def name_key(name: Column) -> Column:
    """A committee's name as its words of letters and digits, in small letters, without the word committee, with or without a plural."""
    words = F.regexp_extract_all(F.lower(name), F.lit("[a-z0-9]+"), F.lit(0))
    return F.array_join(F.filter(words, lambda w: ~w.isin("committee", "committees")), " ")


def committee_code(code: Column, chamber: Column) -> Column:
    c = F.upper(code)
    return F.when((F.lower(chamber) == "house") & c.startswith("HS"), F.substring(c, 3, 1 << 20)).otherwise(c)


def committee_file_code(code: Column) -> Column:
    return F.regexp_replace(code, "00$", "")


def committee_code_in_url(url: Column) -> Column:
    return matched(url, r"/committee/[a-z]+/([a-z0-9]+)")


def amendment_chamber(kind: Column) -> Column:
    return F.when(F.lower(kind) == "hamdt", F.lit("House")).when(F.lower(kind).isin("samdt", "suamdt"), F.lit("Senate"))


def roll_number(action: Column, chamber: Column) -> Column:
    """The number after the words by which a chamber cites a roll: "roll no." or "roll call" in the House, "record vote number" in the Senate."""
    cited = lambda *words: F.try_element_at(F.split(F.regexp_replace(F.lower(action), r"[\s.:]+", " "), "|".join(words), 2), F.lit(2))
    after = F.when(chamber == "House", cited("roll no ", "roll call ")).otherwise(cited("record vote number ", "record vote no "))
    return F.substring_index(F.regexp_replace(after, r"[^0-9]", " "), " ", 1).try_cast("int")


def version_code(name: Column) -> Column:
    return lookup(VERSION_CODES | {c: c for c in VERSION_CODES.values()}, name)


def amendment_version_code(name: Column) -> Column:
    return lookup(AMENDMENT_VERSION_CODES, name)


def role(raw: Column) -> Column:
    return F.when(F.trim(raw).isin(*ROLES), F.trim(raw))


def vote_kind(question: Column) -> Column:
    out = None
    for name, pattern in VOTE_KINDS:
        out = (F if out is None else out).when(question.rlike(pattern), F.lit(name))
    return out.otherwise(F.lit("Other"))


def committee_type(raw: Column, has_parent: Column) -> Column:
    """Known types pass, a missing one follows from the parent, others are standing committees."""
    known = ("Standing", "Subcommittee", "Select", "Special", "Joint", "Task Force", "Other", "Commission or Caucus")
    return F.when(raw.isin(*known), raw).when(raw.isNull() & has_parent, F.lit("Subcommittee")).otherwise(F.lit("Standing"))


def stage_floor(chamber: Column) -> Column:
    return F.when(chamber == "House", F.lit("IH")).when(chamber == "Senate", F.lit("IS"))


def known_or_null(c: Column, domain: tuple[str, ...]) -> Column:
    return F.when(c.isin(*domain), c)


def candidate_vote(cast: Column, kind: Column, known: tuple[str, ...] = ("Yea", "Nay", "Aye", "No", "Present", "Not Voting")) -> Column:
    """struct(position, candidate): in an election a cast that is no ordinary position is a vote for the candidate of that name."""
    named = (kind == "Election") & ~cast.isin(*known)
    return F.struct(F.when(named, F.lit("Candidate")).otherwise(known_or_null(cast, known)).alias("position"), F.when(named, cast).alias("candidate"))

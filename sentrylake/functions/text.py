"""Text rendering and text reading as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentrylake.functions.scalar import _col, clamp01, threat_severity

ColumnOrName = Column | str

# Texts of the reasons and the cut points that produce them.
RARE_BELOW = 0.05
REASON_CRITICAL = "CRITICAL: Highly anomalous behavior detected"
REASON_HIGH = "HIGH: Significant deviation from normal behavior"
REASON_TIME = "Unusual login time (%02d:00)"
REASON_IP = "New or unusual source IP: "
REASON_LOCATION = "New or unusual location: "
REASON_TYPE = "Unusual event type: "
REASON_FAILURE = "User typically has low failure rate"


def anomaly_reasons(
    score: ColumnOrName = "anomaly_score",
    p_hour: ColumnOrName = "p_hour",
    p_ip: ColumnOrName = "p_ip",
    p_geo: ColumnOrName = "p_geo",
    p_type: ColumnOrName = "p_type",
    failure: ColumnOrName = "failure_anomaly",
) -> Column:
    """Ordered messages for everything about the event that its user's history makes rare."""
    score = _col(score)
    rare = lambda p: _col(p) < RARE_BELOW
    return F.array_compact(
        F.array(
            F.when(score >= 0.9, REASON_CRITICAL).when(score >= 0.7, REASON_HIGH),
            F.when(rare(p_hour), F.format_string(REASON_TIME, F.col("hour"))),
            F.when(rare(p_ip), F.concat(F.lit(REASON_IP), F.col("source_ip"))),
            F.when(
                rare(p_geo) & (F.col("geo_location") != ""),
                F.concat(F.lit(REASON_LOCATION), F.col("geo_location")),
            ),
            F.when(rare(p_type), F.concat(F.lit(REASON_TYPE), F.col("event_type"))),
            F.when(_col(failure) > 0, REASON_FAILURE),
        )
    )


def _decimal(x: Column, pattern: str) -> Column:
    """A number by a decimal pattern. It rounds the exact binary value, half to even, as C and Python do."""
    return F.call_function("format_number", x, F.lit(pattern))


def _two(x: Column) -> Column:
    return _decimal(F.coalesce(x, F.lit(0.0)), "0.00")


def short_number(x: ColumnOrName) -> Column:
    """A number with up to six significant digits and no trailing zeros (C's ``%g``), for 0 <= x < 1e6."""
    x = _col(x)
    chain = F.when(x == 0, F.lit("0"))
    # Decimals that leave six significant digits, by magnitude.
    for lower, decimals in [(1e5, 0), (1e4, 1), (1e3, 2), (1e2, 3), (10.0, 4), (1.0, 5),
                            (0.1, 6), (0.01, 7), (0.001, 8), (0.0001, 9)]:
        chain = chain.when(x >= lower, _decimal(x, "0." + "#" * decimals if decimals else "0"))
    return chain.otherwise(F.lower(_decimal(x, "0.#####E00")))


# Labels of the one-line event text, in order; the first four are always there.
TEXT_TYPE = "Security Event: "
TEXT_USER = "User: "
TEXT_SOURCE = "Source IP: "
TEXT_SCORE = "Threat Score: "
TEXT_OPTIONAL = {
    "destination_ip": "Destination IP: ",
    "file_path": "File: ",
    "domain": "Domain: ",
    "process_name": "Process: ",
}


def _optional(label: str, name: str, end: str) -> Column:
    """``label`` + value + ``end``, or null for an absent or empty value."""
    return F.when(F.col(name) != "", F.concat(F.lit(label), F.col(name), F.lit(end)))


def event_text(score: ColumnOrName = "threat_score") -> Column:
    """One-line description of an event, the text that similarity search works on."""
    sentence = lambda label, name: F.concat(F.lit(label), F.col(name), F.lit("."))
    return F.concat_ws(
        " ",
        sentence(TEXT_TYPE, "event_type"),
        sentence(TEXT_USER, "user"),
        sentence(TEXT_SOURCE, "source_ip"),
        *[_optional(label, name, ".") for name, label in TEXT_OPTIONAL.items()],
        F.concat(F.lit(TEXT_SCORE), short_number(score)),
    )


# The wording of the analysis prompt.
PROMPT_OPENING = (
    "You are a cybersecurity analyst. Analyze this security event and provide a detailed threat assessment.\n"
)
PROMPT_CLOSING = """
Provide your analysis in the following JSON format:
{
  "attack_type": "<type of attack, e.g., Brute Force, DDoS, Malware, etc.>",
  "description": "<2-3 sentence natural language explanation of the threat>",
  "recommendations": ["<action 1>", "<action 2>", "<action 3>"],
  "confidence": <0.0-1.0>
}

Consider MITRE ATT&CK tactics and techniques in your analysis. Be specific and actionable."""


# The detail lines of the prompt, in order; the first four are always there.
PROMPT_HEADING = "EVENT DETAILS:"
PROMPT_LINES = {
    "event_id": "- Event ID: ",
    "event_type": "- Type: ",
    "user": "- User: ",
    "source_ip": "- Source IP: ",
    "destination_ip": "- Destination IP: ",
    "file_path": "- File Path: ",
    "domain": "- Domain: ",
    "process_name": "- Process: ",
}
PROMPT_SCORE = "- Threat Score: "
PROMPT_SCALE = " (0.0-1.0)"
PROMPT_TIME = "- Timestamp: "


def analysis_prompt() -> Column:
    """The multi-line prompt that asks for an assessment of the event."""
    return F.concat_ws(
        "\n",
        F.lit(PROMPT_OPENING),
        F.lit(PROMPT_HEADING),
        *[_optional(label, name, "") for name, label in PROMPT_LINES.items()],
        F.concat(F.lit(PROMPT_SCORE), short_number("threat_score"), F.lit(PROMPT_SCALE)),
        F.concat(F.lit(PROMPT_TIME), F.col("ts_ms").cast("string")),
        F.lit(PROMPT_CLOSING),
    )


def extract_json_block(text: ColumnOrName) -> Column:
    """From the first ``{`` to the last ``}``, or the text itself if there is no such block."""
    block = F.regexp_extract(_col(text), r"(?s)\{.*\}", 0)
    return F.when(block != "", block).otherwise(_col(text))


def parse_analysis_response(response: ColumnOrName = "response", score: ColumnOrName = "threat_score") -> Column:
    """A model response as an analysis struct, null where it cannot be read.

    The response wraps the message text, the message wraps the JSON answer.
    Missing fields take defaults; a field of the wrong kind voids the answer;
    recommendations that are not strings are left out.
    """
    content = F.get_json_object(response, "$.choices[0].message.content")
    has_block = F.regexp_like(content, F.lit(r"(?s)\{.*\}"))
    answer = F.try_parse_json(F.when(has_block, extract_json_block(content)))
    field = lambda name, kind: F.try_variant_get(answer, f"$.{name}", kind)

    def kind_of(name: str) -> Column:
        return F.schema_of_variant(field(name, "variant"))

    texts_ok = [
        field(name, "variant").isNull() | (kind_of(name) == "STRING") for name in ("attack_type", "description")
    ]
    number_ok = field("confidence", "variant").isNull() | kind_of("confidence").rlike("^(BIGINT|DOUBLE|DECIMAL)")
    strings = F.filter(
        field("recommendations", "array<variant>"), lambda v: F.schema_of_variant(v) == "STRING"
    )
    readable = answer.isNotNull() & texts_ok[0] & texts_ok[1] & number_ok
    return F.when(
        readable,
        F.struct(
            threat_severity(score).alias("severity"),
            F.coalesce(field("attack_type", "string"), F.lit("Unknown")).alias("attack_type"),
            F.coalesce(field("description", "string"), F.lit("No description provided")).alias("description"),
            F.coalesce(
                F.transform(strings, lambda v: F.try_variant_get(v, "$", "string")),
                F.array().cast("array<string>"),
            ).alias("recommendations"),
            F.coalesce(field("confidence", "double"), F.lit(0.5)).alias("confidence"),
        ),
    )


# How a recommendation section and its items look.
SECTION_PATTERN = r"(?is)\*\*Recommendations\*\*:(.*?)(?:\*\*|$)"
ITEM_PATTERN = r"^(?:\d+\.|[-*])\s+(.+)$"
MIN_ITEM_CHARS = 10
MAX_ITEMS = 5


def extract_recommendations(answer: ColumnOrName) -> Column:
    """Up to five numbered or bulleted items of the recommendation section, else of the whole answer."""
    answer = _col(answer)
    section = F.when(
        F.regexp_like(answer, F.lit(SECTION_PATTERN)), F.regexp_extract(answer, SECTION_PATTERN, 1)
    ).otherwise(answer)
    blank = r"^\s+|\s+$"
    items = F.transform(
        F.split(section, "\n"),
        lambda line: F.regexp_replace(
            F.regexp_extract(F.regexp_replace(line, blank, ""), ITEM_PATTERN, 1), blank, ""
        ),
    )
    return F.slice(F.filter(items, lambda item: F.length(item) > MIN_ITEM_CHARS), 1, MAX_ITEMS)


# How much each kind of context adds to the confidence in an answer.
BASE_CONFIDENCE = 0.5
PER_EVENT, MOST_FROM_EVENTS = 0.02, 0.2
FROM_RELEVANCE = 0.2
FROM_REALTIME, FROM_BATCH = 0.05, 0.1
MOST_CONFIDENCE = 0.99
# Names of the sources of an answer, beside the model provider.
SOURCE_EVENTS, SOURCE_INTEL, SOURCE_BATCH = "java_api", "rag_service", "batch-ml"


def answer_confidence(
    n_events: ColumnOrName,
    avg_relevance: ColumnOrName,
    has_realtime: ColumnOrName,
    has_batch: ColumnOrName,
) -> Column:
    """Confidence in an answer from how much context it had; ``avg_relevance`` is null without intelligence."""
    return F.least(
        F.lit(MOST_CONFIDENCE),
        F.lit(BASE_CONFIDENCE)
        + F.least(F.lit(MOST_FROM_EVENTS), _col(n_events) * PER_EVENT)
        + F.coalesce(_col(avg_relevance) * FROM_RELEVANCE, F.lit(0.0))
        + F.when(_col(has_realtime), FROM_REALTIME).otherwise(0.0)
        + F.when(_col(has_batch), FROM_BATCH).otherwise(0.0),
    )


def sources_used(
    n_events: ColumnOrName, n_intel: ColumnOrName, has_batch: ColumnOrName, provider: str = "openai"
) -> Column:
    """Names of the sources that contributed to an answer."""
    return F.array_compact(
        F.array(
            F.lit(provider),
            F.when(_col(n_events) > 0, SOURCE_EVENTS),
            F.when(_col(n_intel) > 0, SOURCE_INTEL),
            F.when(_col(has_batch), SOURCE_BATCH),
        )
    )


def truncate_summary(document: ColumnOrName, limit: int = 500) -> Column:
    return F.substring(_col(document), 1, limit)


def relevance(distance: ColumnOrName) -> Column:
    return clamp01(1.0 - _col(distance))


# Texts of the context listings. "{}" marks a value.
EVENT_LINE = "{}. [{}] {} - User: {}, IP: {}, Severity: {}, Threat Score: {}"
MORE_EVENTS = "\n\n... and {} more events"
NO_EVENTS = "No events found in the specified time window."
INTEL_LINE = "{}. [{}] (Relevance: {})\n   {}"
NO_INTEL = "No matching threat intelligence found in knowledge base."
NO_SUMMARY = "No summary available"
NO_ANOMALIES = "No anomaly analysis available for this query."
REALTIME_BLOCK = (
    "**Real-time Anomaly Detection** (Speed Layer):\n"
    "  Anomaly Score: {} (0.0 = normal, 1.0 = highly anomalous)\n"
    "  Baseline Deviation: N/A\n"
    "  User Baseline Events: N/A"
)
BATCH_BLOCK = (
    "**Batch ML Anomaly Detection** (Spark ML Pipeline):\n"
    "  Anomaly Score: {} (0.0 = normal, 1.0 = highly anomalous)\n"
    "  Total Events Analyzed: {}\n"
    "  Average Threat Score: {}\n"
    "  Unique IPs: {}\n"
    "  Failed Auth Rate: {}%\n"
    "  Note: Batch analysis provides comprehensive historical behavior patterns"
)
LISTED_EVENTS, LISTED_INTEL = 10, 5


def _filled(template: str, *values: Column) -> Column:
    """The template with its ``{}`` marks replaced by the values, as one concatenation."""
    first, *rest = template.split("{}")
    parts = [F.lit(first)]
    for value, fixed in zip(values, rest, strict=True):
        parts += [value, F.lit(fixed)]
    return F.concat(*parts)


def event_line(position: Column, e: Column) -> Column:
    """One numbered line of an event listing; ``e`` is a struct."""
    known = lambda c: F.coalesce(c, F.lit("unknown"))
    return _filled(
        EVENT_LINE,
        position.cast("string"),
        known(e["ts_ms"].cast("string")),
        known(e["event_type"]),
        known(e["user"]),
        known(e["source_ip"]),
        F.coalesce(e["severity"], F.lit("MEDIUM")),
        _two(e["threat_score"]),
    )


def format_events(top: ColumnOrName, total: ColumnOrName) -> Column:
    """Event listing from the (at most ten) newest events and the count of all."""
    n = F.coalesce(_col(total), F.lit(0))
    lines = F.array_join(F.transform(_col(top), lambda e, i: event_line(i + 1, e)), "\n")
    more = F.when(n > LISTED_EVENTS, _filled(MORE_EVENTS, (n - LISTED_EVENTS).cast("string"))).otherwise("")
    return F.when(n == 0, NO_EVENTS).otherwise(F.concat(lines, more))


def format_intel(top: ColumnOrName) -> Column:
    """Listing of up to five matches; each is a struct of source, summary and relevance_score."""
    matches = _col(top)
    lines = F.transform(
        F.slice(matches, 1, LISTED_INTEL),
        lambda m, i: _filled(
            INTEL_LINE,
            (i + 1).cast("string"),
            F.coalesce(m["source"], F.lit("unknown")),
            _two(m["relevance_score"]),
            F.coalesce(m["summary"], F.lit(NO_SUMMARY)),
        ),
    )
    return F.when(F.coalesce(F.size(matches), F.lit(0)) <= 0, NO_INTEL).otherwise(F.array_join(lines, "\n"))


def format_anomalies(realtime_score: ColumnOrName, batch: ColumnOrName) -> Column:
    """The anomaly block of both layers; ``batch`` is a struct of the batch row or null."""
    realtime, b = _col(realtime_score), _col(batch)
    number = lambda c: F.coalesce(c, F.lit(0)).cast("string")
    batch_text = _filled(
        BATCH_BLOCK,
        _two(b["anomaly_score_normalized"]),
        number(b["total_events"]),
        _two(b["avg_threat_score"]),
        number(b["unique_ips"]),
        _two(b["failed_auth_rate"] * 100),
    )
    blocks = F.concat_ws(
        "\n\n",
        F.when(realtime.isNotNull(), _filled(REALTIME_BLOCK, _two(realtime))),
        F.when(b.isNotNull(), batch_text),
    )
    return F.when(realtime.isNull() & b.isNull(), NO_ANOMALIES).otherwise(blocks)

"""Event, detail and result schemas (as DDL), and the fixed values of the data model."""

from __future__ import annotations

# Enumerations of the event format.
EVENT_TYPES = ("auth_attempt", "network_connection", "file_access", "process_execution", "dns_query")
STATUSES = ("success", "failed", "blocked", "pending")
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")

# Validation limits of an event.
EVENT_ID_PATTERN = r"^evt_[a-zA-Z0-9]{12}$"
IP_PATTERN = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"
MIN_TS_MS = 1_600_000_000_000
MAX_TS_MS = 2_000_000_000_000

# Field that carries the typed details of each event type.
DETAIL_FIELDS = {
    "auth_attempt": "auth_details",
    "network_connection": "network_details",
    "file_access": "file_details",
    "process_execution": "process_details",
    "dns_query": "dns_details",
}


METADATA = (
    "user_agent string, geo_location string, port int, protocol string, file_path string, "
    "process_name string, domain string, bytes_transferred bigint, hostname string, session_id string"
)

DETAILS = {
    "auth_details": (
        "auth_type string, status string, failure_reason string, attempts_count int, "
        "previous_success_timestamp bigint"
    ),
    "network_details": (
        "protocol string, source_port int, destination_port int, bytes_sent bigint, "
        "bytes_received bigint, duration_ms bigint, destination_hostname string, connection_state string"
    ),
    "file_details": (
        "file_path string, operation string, file_size_bytes bigint, file_hash string, "
        "is_encrypted boolean, permissions_changed boolean, access_denied boolean"
    ),
    "process_details": (
        "process_name string, process_id int, parent_process_id int, command_line string, "
        "executable_path string, executable_hash string, user_privileges string, "
        "is_signed boolean, signer string"
    ),
    "dns_details": (
        "query_name string, query_type string, response_code string, resolved_ips array<string>, "
        "ttl int, is_cached boolean, dns_server string"
    ),
}

CORRUPT = "_corrupt"

# One typed payload; every variant's details sit side by side and stay null unless present.
EVENT_PAYLOAD = ", ".join(
    [
        "event_id string, timestamp bigint, event_type string, source_ip string, destination_ip string",
        "user string, status string, threat_score double",
        f"metadata struct<{METADATA}>",
        *[f"{name} struct<{fields}>" for name, fields in DETAILS.items()],
        f"{CORRUPT} string",
    ]
)

# The lenient batch reader takes everything as text and casts afterwards.
BATCH_PAYLOAD = (
    "event_id string, timestamp string, event_type string, user string, source_ip string, "
    "destination_ip string, location string, status string, threat_score string, details string, "
    "metadata struct<geo_location: string>"
)

ANOMALY = (
    "event_id string, user string, ts_ms bigint, anomaly_score double, time_anomaly double, "
    "ip_anomaly double, location_anomaly double, type_anomaly double, failure_anomaly double, "
    "reasons array<string>"
)

ANALYSIS = (
    "event_id string, severity string, attack_type string, description string, "
    "recommendations array<string>, confidence double, ts_s bigint"
)

BATCH_ANOMALY = (
    "user string, anomaly_score_normalized double, total_events bigint, avg_threat_score double, "
    "unique_ips bigint, failed_auth_rate double, is_anomaly int"
)

ANOMALY_REPORT = (
    "total_users bigint, anomalous_users bigint, anomaly_rate double, "
    "top_anomalies array<struct<user: string, anomaly_score_normalized: double, "
    "total_events: bigint, avg_threat_score: double>>"
)

THREAT_INTEL = (
    "id string, description string, category string, severity string, mitre_attack string"
)

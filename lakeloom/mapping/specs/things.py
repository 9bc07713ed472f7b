"""Bronze tables about devices, shipments, groups, subgroups and identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lakeloom.functions.nested import some_lack, truthy
from lakeloom.mapping.spec import (
    Body,
    Derived,
    Mapping,
    group,
    if_missing,
    if_null,
    listing,
    optional,
    required,
)

DATALAKE_MESSAGE = Mapping(
    "datalake_message", ("datalake_message_created",), (optional("type"), optional("date"))
)

EXTERNAL_ID = Mapping(
    "external_id",
    ("external_id_created", "external_id_deleted"),
    (required("domain"), required("key"), required("value"), required("cardinality")),
)

SENSOR_SYNC = Mapping(
    "sensor_sync",
    ("sensor_first_sync", "sensor_synchronized"),
    (required("mac"), required("medication_id", "mid")),
)


def _kept(name: str) -> Derived:
    """Array without empty elements, left out when nothing remains."""

    def build(body: Body) -> Column:
        kept = truthy(body[name])
        return F.when(F.size(kept) > 0, kept)

    return Derived(name, {name: ["string"]}, build)


APP_HEARTBEAT = Mapping(
    "app_heartbeat",
    ("app_heartbeat_created",),
    (
        optional("app_heartbeat_id", "_id"),
        optional("platform"),
        optional("rid"),
        optional("app_version", "app_version"),
        optional("model"),
        optional("date_created", "dateC"),
        optional("packet_type", "packet_type"),
        optional("signed_in", "signed_in", "boolean"),
        optional("timestamp", "dateC"),
        optional("device_id", "device_id"),
        optional("os_version", "os_version"),
        optional("push_on", "push_on", "boolean"),
        _kept("push_type"),
        optional("network_type", "network_type"),
        optional("latitude", "lat", "double"),
        optional("longitude", "lng", "double"),
        optional("location_on", "location_on", "boolean"),
        optional("location_fix_time", "location_fix_time"),
        optional("heartbeat_count", "heartbeat_count", "bigint"),
        optional("launch_count", "launch_count", "bigint"),
        optional("location_type", "location_type"),
        optional("launch_reason", "launch_reason"),
        optional("bluetooth_status", "bluetooth_status"),
        optional("app_state", "app_state"),
        optional("precision", kind="double"),
        optional("location_status", "location_status"),
        optional("ble_support", "ble_support", "boolean"),
        optional("activity_on", "activity_on", "boolean"),
        _kept("activity_type"),
    ),
)

# Fields of the extended sensor status with their types and defaults.
EXTENDED_STATUS = {
    "moved": ("truth", False),
    "installed": ("truth", False),
    "orientation": ("truth", False),
    "silent": ("truth", False),
    "temperature": ("double", -3000.0),
    "wake_up_count": ("cut", -1),
    "awake_time": ("cut", -1),
    "manual_heartbeat": ("truth", False),
    "reset_cause": ("cut", -1),
    "reset_cause_sw": ("cut", -1),
    "ms_depressed": ("cut", -1),
    "sunfish_state": ("string", "-1"),
    "inhale_peak": ("cut", -1),
    "inhale_duration": ("double", -1.0),
    "removal_threshold": ("cut", -1),
    "event_threshold": ("cut", -1),
    "ir_reference": ("cut", -1),
    "time_since_opened": ("cut", -1),
    "med_removal_count": ("cut", -1),
    "peak_to_mean_ratio": ("cut", -1),
    "peak_count": ("cut", -1),
    "inhale_mean_square": ("cut", -1),
    "press_count": ("cut", -1),
    "shake_duration": ("cut", -1),
    "shake_intensity": ("cut", -1),
    "press_to_inhale": ("cut", -1),
    "average_volume": ("cut", -1),
    "total_volume": ("cut", -1),
    "total_volume_first_second": ("cut", -1),
    "inhale_start_to_peak": ("cut", -1),
}


def _truth(value: Column) -> Column:
    """Truth of any JSON value: text is true when not empty, numbers when not zero."""
    text = F.try_variant_get(value, "$", "string")
    return F.when(F.schema_of_variant(value) == "STRING", text != "").otherwise(
        F.try_variant_get(value, "$", "boolean")
    )


def _status_type() -> dict:
    return {name: "variant" if kind == "truth" else kind for name, (kind, _) in EXTENDED_STATUS.items()}


def _extended_status(body: Body) -> Column:
    status = F.get(body["ext_status"], F.lit(0))
    parts = []
    for name, (kind, default) in EXTENDED_STATUS.items():
        value = _truth(status[name]) if kind == "truth" else status[name]
        parts.append(F.coalesce(value, F.lit(default)).alias(name))
    return F.when(F.size(body["ext_status"]) > 0, F.struct(*parts))


LOCATION_TYPE = {"loc": ["double"], "locP": "double", "locM": "string", "loc_time": "string"}


def _fix(name: str, pick) -> Derived:
    """A column of the sensor's position, only when it is a pair of non-zero numbers."""

    def build(body: Body) -> Column:
        loc = body["loc"]
        usable = (F.size(loc) == 2) & (F.get(loc, F.lit(0)) != 0) & (F.get(loc, F.lit(1)) != 0)
        return F.when(usable, pick(body))

    return Derived(name, LOCATION_TYPE, build)


SENSOR_MESSAGE = Mapping(
    "sensor_message",
    ("sensor_message_created",),
    (
        optional("type", "typ"),
        optional("raw"),
        optional("device_model", "device_model"),
        optional("system_firmware_version", "system_firmware_version"),
        optional("date_recorded", "dateR"),
        optional("date_saved", "dateS"),
        optional("mac"),
        optional("battery", "bat", "int"),
        optional("firmware_version", "frm"),
        optional("mod"),
        optional("sensor_event_id", "evtid"),
        optional("elapsed", kind="cut"),
        Derived("extended_status", {"ext_status": [_status_type()]}, _extended_status),
        optional("hub_id", "hub_id"),
        _fix("latitude", lambda body: F.get(body["loc"], F.lit(0))),
        _fix("longitude", lambda body: F.get(body["loc"], F.lit(1))),
        _fix("precision", lambda body: body["locP"]),
        _fix("location_method", lambda body: body["locM"]),
        _fix("location_time", lambda body: body["loc_time"]),
        optional("date_proxy_received", "datP"),
        optional("date_proxy_transmitted", "datT"),
        optional("proxy_mac", "trans_mac"),
        optional("proxy_platform", "trans_plat"),
        optional("proxy_platform_version", "trans_ver"),
        optional("proxy_app_version", "app_ver"),
        optional("user_day_id", "userdayId"),
        optional("event_id"),
        optional("medication_id", "mid"),
        if_null("data_link", "datalink", "boolean"),
        if_null("transmission_device_offset", "tzT", default="false"),
        if_null("source", "src", default="false"),
        if_null("sensor_message_id", "_id"),
        optional("event_record_status", "event_record_status"),
    ),
)

SHIPMENT = Mapping(
    "shipment_status",
    ("shipment_status_updated",),
    (
        optional("status"),
        optional("carrier"),
        optional("tracking_code"),
        optional("date_shipped"),
        optional("est_delivery_date"),
        optional("service_level"),
        listing("status_history", fields=[optional("date"), optional("status"), optional("est_delivery_date")]),
        Derived("mac", {"mac": "string"}, lambda body: F.when(F.length(body["mac"]) > 0, body["mac"])),
    ),
)


def _medical_ids_required(body: Body) -> Column:
    def one(m: Column) -> Column:
        return F.struct(
            m["descriptorKey"].alias("descriptor_key"),
            m["isRequired"].alias("is_required"),
            F.coalesce(m["label"], F.lit("")).alias("label"),
            F.coalesce(m["validator"]["en-US"], F.lit("")).alias("validator"),
        )

    items = body["medicalIdsRequired"]
    return F.when(F.size(items) > 0, F.transform(items, one))


def _medical_ids_check(body: Body) -> Column:
    lacking = some_lack(body.variant, "$.body.medicalIdsRequired", "descriptorKey", "isRequired")
    return F.when(lacking, F.lit("missing: medicalIdsRequired[]"))


GROUP = Mapping(
    "group",
    ("group_created", "group_updated"),
    (
        required("act_required", kind="boolean"),
        required("anonymization_method"),
        required("cat_required", kind="boolean"),
        required("country"),
        required("demo_mode_enabled", kind="boolean"),
        listing("diseases", rule="required", empty="empty"),
        required("display_name"),
        required("fb_tracking", kind="boolean"),
        required("hub_allowed", kind="boolean"),
        required("language"),
        required("mailing_address_required", kind="boolean"),
        required("name"),
        required("preemptive_required", kind="boolean"),
        required("provider_enrollment_enabled", kind="boolean"),
        required("self_enrollment_enabled", kind="boolean"),
        required("time_zone"),
        required("time_zone_required", kind="boolean"),
        required("support_phone"),
        required("support_email"),
        listing(
            "additional_user_agreements",
            fields=[
                required("adult_filter"),
                required("disease_filter"),
                required("medication_filter"),
                required("file_name", "filename"),
                if_null("type", default=""),
            ],
        ),
        listing("default_data_consent_forms"),
        optional("default_privacy_policy"),
        optional("default_terms_and_conditions"),
        listing("demographics"),
        optional("device_encryption_and_passcode"),
        optional("max_control_count", kind="int"),
        Derived(
            "medical_ids_required",
            {
                "medicalIdsRequired": [
                    {
                        "descriptorKey": "string",
                        "isRequired": "boolean",
                        "label": "string",
                        "validator": {"en-US": "string"},
                    }
                ]
            },
            _medical_ids_required,
            _medical_ids_check,
        ),
        listing("medication_black_list"),
        listing("medication_white_list"),
        optional("order_trigger_strategy"),
        listing("postal_codes_allowed"),
        optional("protocol"),
        listing("sensor_black_list"),
        listing("strict_dose_medication_list"),
    ),
    group_id_from_body=True,
)

SUBGROUP = Mapping(
    "subgroup",
    ("subgroup_created", "subgroup_deleted", "subgroup_updated"),
    (
        if_missing("subgroup_id", "id"),
        if_missing("name"),
        if_missing("display_name"),
        if_missing("type"),
        Derived("subgroup_external_ids", {"externalIds": ["string"]}, lambda body: body["externalIds"]),
    ),
)

PATIENT_SUBGROUP = Mapping(
    "patient_subgroup",
    ("patient_subgroup_added", "patient_subgroup_removed"),
    (
        Derived("subgroups", {"subgroups": ["string"]}, lambda body: body["subgroups"]),
        Derived(
            "subgroup_modified",
            {},
            lambda body: F.get(body.args, F.lit(0)),
            check=lambda body: F.when(F.coalesce(F.size(body.args), F.lit(0)) < 1, F.lit("missing: pubSubArgs[0]")),
        ),
    ),
    keeps_args=True,
)

MAPPINGS = [
    DATALAKE_MESSAGE,
    EXTERNAL_ID,
    SENSOR_SYNC,
    APP_HEARTBEAT,
    SENSOR_MESSAGE,
    SHIPMENT,
    GROUP,
    SUBGROUP,
    PATIENT_SUBGROUP,
]

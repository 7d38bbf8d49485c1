"""Explicit schemas of the stored tables and documents, as DDL text for the readers."""

from __future__ import annotations

SUBJECTS = ("subject_id string, asset_path string, asset_kind string, status string")
FILES = ("path string, archive string, sha256 string")
ARCHIVES = ("path string, sha256 string, bytes long, uncompressed_bytes long")
REGISTRY = ("subject_id string, asset_kind string, status string, asset_path string")
FACTS = ("path string, exists boolean, bytes long, mtime_ns long, sha256 string")

JOBS = (
    "id long, subject_id string, asset_path string, motion_path string, background_path string, "
    "sample_id string, split string, status string, worker_id string, pid long, attempts long, "
    "started_at timestamp, finished_at timestamp, error string, recipe string, action_design_id string, "
    "action_params_json string, motion_segment_id string, source_start_frame long, frame_count int, "
    "framing string, background_start_sec double, background_motion_hint string"
)
EVENTS = ("job_id long, event string, detail string")
DESIGNS = (
    "job_id long, design_seq long, subject_id string, subject_action_index int, action_design_id string, "
    "inspiration_signature string, blueprint_signature string, action_params_json string"
)
PAIRINGS = (
    "sample_id string, background_ref string, background_start_sec double, compatibility_score double, "
    "precheck_method string, placement_json string, framing string, approval_status string, "
    "manifest_version string"
)
OBSERVATIONS = (
    "segment_id string, motion_path string, source_start long, frame_count long, feature_path string, "
    "trajectory_fingerprint string, status string"
)

FILE_FACT = "struct<path:string,exists:boolean,bytes:bigint,mtime_ns:bigint,sha256:string>"
RECORD = (
    f"schema_version int, status string, job_id long, sample_id string, split string, subject_id string, "
    f"attempt_id string, asset {FILE_FACT}, background {FILE_FACT}, motion {FILE_FACT}, "
    f"code_files_sha256 map<string,string>, setting_file {FILE_FACT}, "
    "outputs struct<video:string,composite_frames:string,alpha_frames:string,metadata:string,"
    "render_report:string,task_preflight:string,done:string>, "
    "video_unique_name string, error string, replay_job string"
)

METRICS = (
    "struct<motion_energy:double,root_path_length:double,root_displacement:array<double>,"
    "joint_axis_ranges:map<string,array<double>>,contact_fraction:map<string,double>,"
    "contact_transitions:map<string,bigint>,knee_angle_ranges:map<string,double>,"
    "elbow_angle_ranges:map<string,double>,body_yaw_range_deg:double,body_yaw_path_deg:double>"
)
FEATURES = (
    "segment_id string, `schema` int, observation_version string, source_frames array<long>, scene_fps double, "
    f"frame_count long, trajectory_fingerprint string, metrics {METRICS}"
)
PRESETS = (
    "preset_id string, catalog_version string, trajectory_descriptor array<double>, "
    "source_trajectory_fingerprint string, blueprint_signature string, trajectory_fingerprint string, "
    "source_segment_id string, source_motion_path string, source_frames array<long>, source_fps double"
)

# Contract versions the readers accept.
OBSERVATION_SCHEMA = 2
OBSERVATION_VERSION = "full-source-observables-v2"
CATALOG_VERSION = "expanded-safe-presets-v4-expanded"
PAIRING_VERSION = "frozen-pairing-v1-6-3-3"
REPORT_VERSION = "task_preflight_v1"
GARMENT_VERSION = "garment_guard_v1"

"""Schemas of the tables that land, for readers that should not infer them."""

from __future__ import annotations

CI_RUNS = (
    "repo string, run_id bigint, run_number bigint, workflow_name string, head_sha string, "
    "head_branch string, actor_login string, conclusion string, created_at timestamp"
)
COMMITS = "repo string, sha string, committed_at timestamp, commit_no bigint, message string, author string"
CHANGED_FILES = (
    "repo string, sha string, file_no bigint, filename string, status string, "
    "additions int, deletions int, patch string"
)
LOG_PARTS = "repo string, run_id bigint, part_no bigint, name string, text string"

GITHUB_PAIRS = (
    "id string, source string, repo string, language string, ci_platform string, run_id bigint, "
    "workflow_name string, failing_sha string, fix_sha string, ci_log string, fix_diff string, "
    "has_fix boolean, dep_drift_mode boolean"
)
HISTORY_PAIRS = (
    "id string, source string, repo string, language string, ci_platform string, workflow_name string, "
    "failing_sha string, fix_sha string, failed_run_id bigint, fix_run_id bigint, ci_log string, "
    "fix_diff string, has_fix boolean, env_mode boolean"
)
GITLAB_PAIRS = (
    "platform string, project_path string, project_url string, pipeline_id bigint, failed_sha string, "
    "branch string, failed_job_name string, failed_stage string, failure_log string, "
    "fix_pipeline struct<pipeline_id: bigint, sha: string, ref: string, commit_message: string, "
    "web_url: string, duration: double>, "
    "has_fix boolean, language string, project_stars bigint, created_at string"
)
TRAVIS_PAIRS = (
    "platform string, repo_slug string, build_number bigint, build_id bigint, branch string, language string, "
    "failed_job_name string, failed_sha string, commit_message string, failure_log string, "
    "fix_build struct<build_number: bigint, commit_sha: string, commit_message: string, "
    "compare_url: string, duration: double>, "
    "has_fix boolean, os string, dist string, started_at string"
)
CIRCLECI_PAIRS = (
    "platform string, project_slug string, repo_url string, pipeline_id string, workflow_name string, "
    "failed_job_name string, failed_sha string, branch string, failure_log string, "
    "fix_commit struct<sha: string, message: string, author: string, files_changed: int, "
    "ci_files_changed: array<string>, diff_patch: string>, "
    "has_fix boolean, created_at string"
)
CLASSIFIED = GITHUB_PAIRS + (
    ", failure_class string, failure_subclass string, classification_confidence double, "
    "classification_source string, root_cause string, fix_strategy string, key_evidence array<string>"
)
AUGMENTED = CLASSIFIED + (
    ", is_synthetic boolean, mutation_strategy string, mutation_description string, "
    "original_record_id string, mutation_index int"
)
DEP_PRS = (
    "type string, repo string, repo_url string, pr_number bigint, pr_url string, title string, "
    "bump_info struct<package: string, from_version: string, to_version: string>, ecosystem string, "
    "merge_status string, ci_result struct<status: string, total_checks: bigint, passed: bigint, failed: bigint, "
    "checks: array<struct<name: string, conclusion: string, app: string>>>, ci_passed boolean, "
    "changed_dep_files array<struct<filename: string, status: string, additions: int, deletions: int, patch: string>>, "
    "num_dep_files_changed int, body_snippet string, created_at string, merged_at string, "
    "labels array<string>, author string"
)
MODEL_VERDICTS = (
    "id string, failure_class string, failure_subclass string, confidence double, root_cause string, "
    "fix_strategy string, key_evidence array<string>"
)
RL_TASKS = (
    "id string, repo string, failing_sha string, language string, ci_log string, failure_class string, "
    "failure_subclass string, test_command string, ground_truth_diff string"
)
DPO_PAIRS = "id string, prompt string, chosen string, rejected string, failure_class string, source string"
PATCH_OUTCOMES = (
    "prompt_id string, generation int, patch_applied boolean, first_run_passed boolean, second_run_passed boolean, "
    "first_run_output string, second_run_output string, execution_time_seconds double, reward double"
)

"""Failure taxonomy: classes, weighted patterns, standard fixes, known failures."""

from __future__ import annotations

from typing import NamedTuple

# ---------------------------------------------------------------------------
# Names, patterns, weights and texts below must stay as they are,
# since results are compared against them.
# ---------------------------------------------------------------------------

CLASSES = [
    "FLAKY",
    "DEP_DRIFT",
    "ENV",
    "LOGIC",
    "SECURITY_AUDIT",
    "LINT_FORMATTING",
    "BUILD_COMPILATION",
    "UNKNOWN",
]

SUBCLASSES = [
    "1a_race_condition",
    "1b_external_dependency",
    "1c_resource_exhaustion",
    "1d_test_ordering",
    "2a_direct_dep_breaking_change",
    "2b_transitive_dep_conflict",
    "2c_build_tool_version",
    "2d_lockfile_stale",
    "3a_base_image_update",
    "3b_runner_os_tool_change",
    "3c_missing_system_dep",
    "3d_secret_env_var_missing",
    "4a_test_expectation_drift",
    "4b_api_contract_break",
    "4c_schema_mismatch",
    "4d_import_error",
    "5a_vulnerability_found",
    "5b_license_violation",
    "5c_secret_detected_in_code",
    "5d_sbom_mismatch",
    "6a_style_violation",
    "6b_type_error",
    "6c_unused_import_variable",
    "6d_complexity_threshold",
    "7a_compile_error",
    "7b_missing_build_artifact",
    "7c_build_cache_invalid",
    "7d_build_tool_version_incompatible",
]


class Pattern(NamedTuple):
    failure_class: str
    failure_subclass: str
    confidence: float
    regex: str


# In rank order: position breaks ties of equal confidence.
PATTERNS = [
    Pattern("FLAKY", "1b_external_dependency", 0.7, r"(timeout|timed out|connection reset|connection refused)"),
    Pattern("FLAKY", "1a_race_condition", 0.8, r"(race condition|data race|concurrent|deadlock)"),
    Pattern("FLAKY", "1c_resource_exhaustion", 0.8, r"(out of memory|oom|disk full|no space left)"),
    Pattern("FLAKY", "1c_resource_exhaustion", 0.7, r"(port \d+ already in use|address already in use)"),
    Pattern("FLAKY", "1d_test_ordering", 0.5, r"(test.*order|ordering.*test|setUp.*failed|fixtures)"),
    Pattern("DEP_DRIFT", "2a_direct_dep_breaking_change", 0.6, r"(ImportError|ModuleNotFoundError|cannot import name)"),
    Pattern("DEP_DRIFT", "2b_transitive_dep_conflict", 0.8, r"(conflicting dependencies|dependency conflict|incompatible)"),
    Pattern("DEP_DRIFT", "2d_lockfile_stale", 0.6, r"(npm ERR!|yarn error|package-lock.json)"),
    Pattern("DEP_DRIFT", "2d_lockfile_stale", 0.85, r"(poetry.lock|Pipfile.lock|Gemfile.lock|go.sum).*out of sync"),
    Pattern("DEP_DRIFT", "2c_build_tool_version", 0.8, r"(python [\d.]+ is not supported|requires python >=)"),
    Pattern("DEP_DRIFT", "2a_direct_dep_breaking_change", 0.75, r"(DeprecationWarning.*removed in|API removed|deprecated.*will be removed)"),
    Pattern("ENV", "3a_base_image_update", 0.9, r"(unable to find image|image not found|manifest unknown)"),
    Pattern("ENV", "3c_missing_system_dep", 0.85, r"(apt-get.*No such file|Package.*has no installation candidate)"),
    Pattern("ENV", "3c_missing_system_dep", 0.85, r"(E: Unable to locate package|dpkg: error)"),
    Pattern("ENV", "3d_secret_env_var_missing", 0.8, r"(Error: \$\{secrets\.|secret.*not found|env.*undefined)"),
    Pattern("ENV", "3b_runner_os_tool_change", 0.8, r"(ubuntu-[\d]+.*deprecated|runner.*not available)"),
    Pattern("ENV", "3b_runner_os_tool_change", 0.6, r"(setup-python.*Node.js|actions/checkout.*version)"),
    Pattern("LOGIC", "4a_test_expectation_drift", 0.6, r"(AssertionError|assert.*!=|Expected.*Got)"),
    Pattern("LOGIC", "4b_api_contract_break", 0.75, r"(TypeError.*argument|TypeError.*keyword|unexpected keyword argument)"),
    Pattern("LOGIC", "4c_schema_mismatch", 0.8, r"(OperationalError|ProgrammingError|column.*does not exist|table.*doesn't exist)"),
    Pattern("LOGIC", "4d_import_error", 0.7, r"(from.*import.*cannot.*import|no module named)"),
    Pattern("LOGIC", "4b_api_contract_break", 0.7, r"(AttributeError.*has no attribute|object has no attribute)"),
    Pattern("SECURITY_AUDIT", "5a_vulnerability_found", 0.85, r"(vulnerability|CVE-\d{4}-\d+|GHSA-|audit\s+found|critical\s+severity)"),
    Pattern("SECURITY_AUDIT", "5b_license_violation", 0.8, r"(license\s+violation|incompatible\s+license|GPL\s+conflict|AGPL)"),
    Pattern("SECURITY_AUDIT", "5c_secret_detected_in_code", 0.9, r"(secret.*detected|token.*exposed|credential.*leak|trufflehog|gitleaks)"),
    Pattern("SECURITY_AUDIT", "5d_sbom_mismatch", 0.8, r"(sbom.*mismatch|sbom.*failed|cyclonedx.*error)"),
    Pattern("LINT_FORMATTING", "6a_style_violation", 0.85, r"(flake8|pylint|eslint|rubocop|golint|checkstyle).*error"),
    Pattern("LINT_FORMATTING", "6b_type_error", 0.85, r"(mypy|pytype|flow.*error|tsc.*error|type.*error)"),
    Pattern("LINT_FORMATTING", "6c_unused_import_variable", 0.8, r"(F401|unused\s+import|unused\s+variable|W0611)"),
    Pattern("LINT_FORMATTING", "6d_complexity_threshold", 0.75, r"(cyclomatic\s+complexity|too\s+complex|C901|function.*too\s+long)"),
    Pattern("LINT_FORMATTING", "6a_style_violation", 0.9, r"(black.*would\s+reformat|prettier.*failed|gofmt.*diff)"),
    Pattern("BUILD_COMPILATION", "7a_compile_error", 0.9, r"(compilation.*failed|cannot\s+compile|undefined\s+reference|linker.*error)"),
    Pattern("BUILD_COMPILATION", "7b_missing_build_artifact", 0.8, r"(could\s+not\s+find\s+artifact|missing.*dist|no\s+such\s+file.*build)"),
    Pattern("BUILD_COMPILATION", "7c_build_cache_invalid", 0.7, r"(cache\s+miss|invalid\s+cache|stale\s+cache|cache\s+expired)"),
    Pattern("BUILD_COMPILATION", "7d_build_tool_version_incompatible", 0.8, r"(gradle\s+version|maven\s+version|cmake.*version|make.*version).*incompatible"),
    Pattern("BUILD_COMPILATION", "7a_compile_error", 0.75, r"(SyntaxError|IndentationError|invalid\s+syntax).*build"),
]

REPEAT_BONUS = 0.05
MAX_CONFIDENCE = 0.95
MIN_SIGNAL = 0.5

DEFAULT_FIX = "Unknown failure sub-class. Perform manual triage."

FIX_STRATEGIES = {
    "1a_race_condition": (
        "Add proper synchronization. Use locks, barriers, or make the test deterministic "
        "by mocking async operations. Do not add `time.sleep()` — that masks the problem."
    ),
    "1b_external_dependency": (
        "Mock external dependencies (HTTP, DB, time). Use `responses`, `httpretty`, "
        "`unittest.mock`, or VCR cassettes. Never rely on external services in CI tests."
    ),
    "1c_resource_exhaustion": (
        "Add resource cleanup in tearDown/fixture. Use dynamic port assignment. "
        "Add `@pytest.mark.flaky(reruns=3)` as a stopgap while root cause is fixed."
    ),
    "1d_test_ordering": (
        "Identify and remove shared state between tests. Use fresh fixtures. "
        "Add `--randomly-seed=0` to pytest to detect ordering dependencies systematically."
    ),
    "2a_direct_dep_breaking_change": (
        "Pin the breaking dependency to the last known-good version. Open a separate "
        "PR to migrate to the new API. Do NOT force-upgrade without addressing the API change."
    ),
    "2b_transitive_dep_conflict": (
        "Add an explicit constraint for the conflicting transitive dep. Use "
        "`pip install --constraint` or add a `constraints.txt`. Regenerate lockfile."
    ),
    "2c_build_tool_version": (
        "Pin the Python/Node/Go version in CI config. Add `.python-version`, "
        "`.nvmrc`, or `go.toolchain` to the repo root."
    ),
    "2d_lockfile_stale": (
        "Regenerate the lockfile: `pip-compile`, `npm install`, `poetry lock --no-update`. "
        "Commit the updated lockfile."
    ),
    "3a_base_image_update": (
        "Pin the Docker base image to a specific digest: "
        "`FROM ubuntu:22.04@sha256:...`. Avoid `:latest` tags in CI Dockerfiles."
    ),
    "3b_runner_os_tool_change": (
        "Pin the GitHub Actions runner to a specific Ubuntu version: "
        "`runs-on: ubuntu-22.04` (not `ubuntu-latest`). Pin action versions to tags, not `@main`."
    ),
    "3c_missing_system_dep": (
        "Add the missing package to the `apt-get install` step in the workflow YAML "
        "or Dockerfile. Check which package provides the missing library via `apt-cache search`."
    ),
    "3d_secret_env_var_missing": (
        "Add the missing secret to GitHub repository secrets. Check the workflow YAML "
        "for `${{ secrets.VAR_NAME }}` and ensure the corresponding secret is configured "
        "in Settings → Secrets and Variables → Actions."
    ),
    "4a_test_expectation_drift": (
        "Update the test expectation to match the new correct behavior. Verify that "
        "the behavior change was intentional by reviewing the PR description."
    ),
    "4b_api_contract_break": (
        "Update callers to match the new API signature. Check the PR that changed "
        "the function signature and update all call sites. Consider adding a deprecation "
        "shim if the old signature needs to be supported."
    ),
    "4c_schema_mismatch": (
        "Add a database migration or update the schema definition. Check if a migration "
        "was added in the same PR as the code change. If not, create and apply it."
    ),
    "4d_import_error": (
        "Update import paths to match the new module structure. Check if modules were "
        "moved or renamed in the failing commit. Update `__init__.py` exports if needed."
    ),
    "5a_vulnerability_found": (
        "Run `npm audit fix`, `pip-audit --fix`, or upgrade the flagged package to the patched version. "
        "Check the CVE details to verify exploitability before suppressing."
    ),
    "5b_license_violation": (
        "Replace the offending package with a license-compatible alternative. "
        "Add it to the license allowlist if business approval exists."
    ),
    "5c_secret_detected_in_code": (
        "Immediately rotate the exposed credential. Remove the secret from git history "
        "using `git filter-repo`. Add the pattern to `.gitignore` and a pre-commit hook."
    ),
    "5d_sbom_mismatch": (
        "Regenerate the SBOM with `syft` or `cyclonedx-cli`. Ensure all dependencies are "
        "declared in the manifest before regenerating."
    ),
    "6a_style_violation": (
        "Run the formatter locally: `black .`, `prettier --write .`, `rubocop -a`. "
        "Add a pre-commit hook to enforce formatting before CI."
    ),
    "6b_type_error": (
        "Fix the type annotation or add a type: ignore comment with explanation. "
        "Run `mypy --strict` locally to find all type errors before pushing."
    ),
    "6c_unused_import_variable": (
        "Remove unused imports. Use `autoflake --remove-all-unused-imports` or "
        "your IDE's 'Optimize Imports' feature."
    ),
    "6d_complexity_threshold": (
        "Refactor the complex function into smaller helper functions. "
        "Target cyclomatic complexity <= 10 per function."
    ),
    "7a_compile_error": (
        "Fix the compilation error shown in the log. Check for missing type annotations, "
        "undefined symbols, or incompatible API changes in recent commits."
    ),
    "7b_missing_build_artifact": (
        "Add the missing build step that generates the artifact. Ensure build steps "
        "are ordered correctly in the CI workflow."
    ),
    "7c_build_cache_invalid": (
        "Clear the CI cache and retry. If this recurs, pin cache keys to "
        "lockfile hashes: `hashFiles('**/package-lock.json')`."
    ),
    "7d_build_tool_version_incompatible": (
        "Pin the build tool version in CI: add `.gradle-version`, "
        "`mvn.version` property, or equivalent. Match the version used locally."
    ),
}


class KnownFailure(NamedTuple):
    name: str
    failure_class: str
    failure_subclass: str
    signatures: list[str]
    languages: list[str]
    fix_template: str
    description: str


# Signatures are literal substrings, also those that look like patterns.
KNOWN_FAILURES = [
    KnownFailure(
        "psycopg2_to_psycopg3", "DEP_DRIFT", "2a_direct_dep_breaking_change",
        ["cannot import name 'connect' from 'psycopg'", "psycopg 3"], ["python"],
        "Pin psycopg to <3.0 in requirements: psycopg>=2.9,<3.0",
        "psycopg3 changed its public API; psycopg 2.x must be pinned explicitly",
    ),
    KnownFailure(
        "setuptools_pkg_resources_removal", "DEP_DRIFT", "2a_direct_dep_breaking_change",
        ["from pkg_resources import", "pkg_resources has been removed"], ["python"],
        "Add explicit setuptools dependency or migrate to importlib.resources",
        "setuptools 67+ removed pkg_resources; need explicit dependency or migration",
    ),
    KnownFailure(
        "poetry_lock_outdated", "DEP_DRIFT", "2d_lockfile_stale",
        ["poetry.lock is not up to date", "run poetry lock"], ["python"],
        "Run: poetry lock --no-update && commit poetry.lock",
        "poetry.lock is out of sync with pyproject.toml",
    ),
    KnownFailure(
        "pydantic_v1_v2_migration", "DEP_DRIFT", "2a_direct_dep_breaking_change",
        ["validator.*is not a class", "model_validator", "pydantic"], ["python"],
        "Pin pydantic to <2.0 or migrate validators to v2 style (@model_validator)",
        "Pydantic v2 broke v1 validator decorators; must pin or migrate",
    ),
    KnownFailure(
        "ubuntu_24_libssl", "ENV", "3c_missing_system_dep",
        ["libssl-dev has no installation candidate", "ubuntu-24"], ["python", "ruby", "rust"],
        "Replace 'libssl-dev' with 'openssl' in apt-get install step",
        "Ubuntu 24.04 restructured OpenSSL packages",
    ),
    KnownFailure(
        "actions_checkout_v4_node", "ENV", "3b_runner_os_tool_change",
        ["Node.js 12 actions are deprecated", "actions/checkout@v1"],
        ["python", "javascript", "go", "java", "ruby"],
        "Upgrade actions/checkout to @v4, actions/setup-python to @v5",
        "GitHub deprecated Node.js 12/16 actions; must upgrade to v4+",
    ),
    KnownFailure(
        "docker_latest_tag", "ENV", "3a_base_image_update",
        ["FROM.*:latest", "E: Package.*no installation candidate"], ["python", "javascript", "go"],
        "Pin FROM image to specific version: FROM ubuntu:22.04 (not :latest)",
        ":latest Docker tags change silently; pin to specific version",
    ),
    KnownFailure(
        "asyncio_event_loop_closed", "FLAKY", "1a_race_condition",
        ["Event loop is closed", "RuntimeError: no running event loop"], ["python"],
        "Use asyncio.new_event_loop() in pytest fixture, close in teardown",
        "Async tests sharing event loop cause RuntimeError when loop closes",
    ),
    KnownFailure(
        "port_already_in_use", "FLAKY", "1c_resource_exhaustion",
        ["Address already in use", "port.*already in use", "EADDRINUSE"], ["python", "javascript", "go"],
        "Use port=0 (OS-assigned) for test servers, or add ephemeral port fixture",
        "Hardcoded ports conflict when tests run in parallel or in rapid succession",
    ),
    KnownFailure(
        "datetime_timezone_flaky", "FLAKY", "1b_external_dependency",
        ["AssertionError.*datetime", "timezone", "utcnow"], ["python"],
        "Mock datetime.now() in tests; use freeze_gun or unittest.mock.patch",
        "Tests comparing datetime.now() are non-deterministic across timezones",
    ),
]

"""Mutation queries."""

from __future__ import annotations

from buildmend.operators import augment
from checks.registry import query
from checks.sql import choice, drawn

_OUT = "id, repo, ci_log, mutation_strategy, mutation_description, original_record_id, mutation_index"


def _steps(name: str, pattern: str, index: int, flags: str = "(?i)") -> str:
    """CTE ``m_<name>``: logs with matches, the picked match and the text ahead of it."""
    rx = f"'{flags}{pattern}'"
    return f"""m_{name} AS (SELECT id, repo, ci_log, regexp_extract_all(ci_log, {rx}, 0) AS g0, regexp_extract_all(ci_log, {rx}, 1) AS g1, regexp_extract_all(ci_log, {rx}, 2) AS g2,
  string_split_regex(ci_log, {rx}) AS gaps FROM ci_pairs),
k_{name} AS (SELECT *, {drawn('ci_log', index, 0, 'len(g0)')} + 1 AS k FROM m_{name} WHERE len(g0) > 0),
at_{name} AS (SELECT *, length(array_to_string(gaps[1:k], '')) + coalesce(length(array_to_string(g0[1:k - 1], '')), 0) AS start FROM k_{name})"""


def _made(name: str, index: int, body: str) -> str:
    """CTE ``v_<name>``: the variants of one strategy; ``body`` selects id, repo, old log, new log, description."""
    return f"""v_{name} AS (SELECT id, repo, new_log AS ci_log, '{name}' AS mutation_strategy, d AS mutation_description,
  sha256(ci_log) AS original_record_id, {index} AS mutation_index FROM ({body}) WHERE new_log <> ci_log)"""


def _pick(options: str, index: int, turn: int) -> str:
    return f"{options}[{drawn('ci_log', index, turn, f'len({options})')} + 1]"


def python_steps(i: int) -> str:
    options = f"list_filter({choice(augment.PYTHON_VERSIONS)}, lambda v: v <> old)"
    return _steps("python_version", r"python(\s+|\-|:)([23]\.\d+(?:\.\d+)?)", i) + ",\n" + _made("python_version", i, f"""
      SELECT *, left(ci_log, start + length(g0[k]) - length(old)) || new || substr(ci_log, start + length(g0[k]) + 1) AS new_log,
        'Python version changed from ' || old || ' to ' || new AS d FROM (SELECT *, {_pick(options, i, 1)} AS new FROM (SELECT *, g2[k] AS old FROM at_python_version))""")


def node_steps(i: int) -> str:
    options = f"list_filter({choice(augment.NODE_VERSIONS)}, lambda v: NOT starts_with(v, old))"
    return _steps("node_version", r"node(\s+|\-|:)(v?1[46-9]|2[01])\.\d+(?:\.\d+)?", i) + ",\n" + _made("node_version", i, f"""
      SELECT *, left(ci_log, start + 4 + length(g1[k])) || new || substr(ci_log, start + 4 + length(g1[k]) + length(old) + 1) AS new_log,
        'Node.js version changed from ' || old || ' to ' || new AS d FROM (SELECT *, {_pick(options, i, 1)} AS new FROM (SELECT *, g2[k] AS old FROM at_node_version))""")


def _swap(old: str, new: str) -> str:
    return f"CASE WHEN contains(ci_log, {old}) THEN left(ci_log, instr(ci_log, {old}) - 1) || {new} || substr(ci_log, instr(ci_log, {old}) + length({old})) ELSE ci_log END"


def runner_steps(i: int) -> str:
    options = f"list_filter({choice(augment.RUNNERS)}, lambda v: v <> old)"
    return _steps("runner_version", r"ubuntu-(\d+\.\d+|latest)()", i) + ",\n" + _made("runner_version", i, f"""
      SELECT *, {_swap('old', 'new')} AS new_log, 'Runner changed from ' || old || ' to ' || new AS d
      FROM (SELECT *, {_pick(options, i, 1)} AS new FROM (SELECT *, 'ubuntu-' || g1[k] AS old FROM at_runner_version))""")


def docker_steps(i: int) -> str:
    py, node = choice(augment.PYTHON_IMAGES), choice(augment.NODE_IMAGES)
    return _steps("docker_image", r"FROM\s+(python|node):([^\s\n]+)", i) + ",\n" + _made("docker_image", i, f"""
      SELECT *, left(ci_log, length(gaps[1]) + length(g0[1]) - length(old)) || new || substr(ci_log, length(gaps[1]) + length(g0[1]) + 1) AS new_log,
        'Docker base image changed from ' || old || ' to ' || new AS d
      FROM (SELECT *, CASE WHEN lower(g1[1]) = 'python' THEN {_pick(py, i, 0)} ELSE {_pick(node, i, 0)} END AS new, g1[1] || ':' || g2[1] AS old FROM at_docker_image) WHERE new <> old""")


def env_steps(i: int) -> str:
    pattern = r"\$\{\{?\s*secrets\.(\w+)\s*\}\}?|\$(\w+_KEY|\w+_TOKEN|\w+_SECRET)"
    return _steps("env_var", pattern, i, "") + ",\n" + _made("env_var", i, f"""
      SELECT *, {_swap('old', 'new')} AS new_log, 'Environment variable renamed from ' || old || ' to ' || new AS d
      FROM (SELECT *, old || {_pick(choice(augment.NAME_SUFFIXES), i, 1)} AS new FROM (SELECT *, coalesce(nullif(g1[k], ''), g2[k]) AS old FROM at_env_var))""")


def package_steps(i: int) -> str:
    return _steps("package_version", r"requests[=<>^~\s:]+(\d+)\.(\d+)\.(\d+)", i) + ",\n" + _made("package_version", i, f"""
      SELECT *, left(ci_log, length(gaps[1]) + length(g0[1]) - length(old)) || new || substr(ci_log, length(gaps[1]) + length(g0[1]) + 1) AS new_log,
        'requests version changed from ' || old || ' to ' || new AS d
      FROM (SELECT *, v[1] || '.' || v[2] || '.' || v[3] AS old, CASE {_pick(choice(augment.VERSION_BUMPS), i, 0)}
          WHEN 'patch_bump' THEN v[1] || '.' || v[2] || '.' || (v[3]::INT + 1 + {drawn('ci_log', i, 1, '5')})
          WHEN 'minor_bump' THEN v[1] || '.' || (v[2]::INT + 1 + {drawn('ci_log', i, 1, '3')}) || '.0'
          ELSE (v[1]::INT + 1) || '.0.0' END AS new
        FROM (SELECT *, string_split(regexp_extract(g0[1], '\\d+\\.\\d+\\.\\d+'), '.') AS v FROM at_package_version))""")


def _single(key: str, name: str, steps) -> None:
    query(key, ["ci_pairs"], steps=steps(0), sql=f"SELECT {_OUT} FROM v_{name}")(
        lambda t: augment.mutate(t.ci_pairs, names=[name]).select(*_OUT.split(", "))
    )


_single("mutate_python", "python_version", python_steps)
_single("mutate_node", "node_version", node_steps)
_single("mutate_runner", "runner_version", runner_steps)
_single("mutate_docker", "docker_image", docker_steps)
_single("mutate_env", "env_var", env_steps)


@query("mutate_package", ["ci_pairs"], steps=package_steps(0), sql=f"SELECT {_OUT} FROM v_package_version")
def mutate_package(t):
    bump = augment.Strategy("package_version", augment.package_version("requests"))
    return augment.mutate(t.ci_pairs, [bump]).select(*_OUT.split(", "))


_ALL = [python_steps, node_steps, runner_steps, docker_steps, env_steps]


@query(
    "mutate_all", ["ci_pairs"], steps=",\n".join(steps(i) for i, steps in enumerate(_ALL)),
    sql=f"""SELECT {_OUT} FROM (SELECT * FROM v_python_version UNION ALL SELECT * FROM v_node_version UNION ALL SELECT * FROM v_runner_version
      UNION ALL SELECT * FROM v_docker_image UNION ALL SELECT * FROM v_env_var)""",
)
def mutate_all(t):
    return augment.mutate(t.ci_pairs).select(*_OUT.split(", "))

"""Declared schemas. Nothing in the library relies on JSON type inference."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

CORRUPT = "_corrupt_record"


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_S, _L, _I, _B, _D = StringType(), LongType(), IntegerType(), BooleanType(), DoubleType()

MESSAGE = _struct(role=_S, content=_S)
MESSAGES = ArrayType(MESSAGE, True)

CORPUS_FILE = _struct(
    id=_S, source=_S, code=_S, file_path=_S, repo_url=_S, repo_owner=_S, repo_name=_S,
    repo_description=_S, stars=_L, is_official=_B, license=_S, license_raw=_S,
    authors=ArrayType(_S), package=_S, package_downloads=_L, fork=_B, archived=_B,
    collected_at=_S, commit_sha=_S, schema_version=_I,
)

REPO = _struct(
    owner=_S, name=_S, url=_S, description=_S, stars=_L, license_raw=_S, authors=ArrayType(_S),
    fork=_B, archived=_B, package=_S, package_downloads=_L,
)

SEARCH_ITEM = _struct(
    owner=_struct(login=_S), full_name=_S, html_url=_S, description=_S, stargazers_count=_L,
    license=_struct(spdx_id=_S), fork=_B, archived=_B,
)

PACKAGE_ITEM = _struct(
    name=_S,
    meta=_struct(links=_struct(GitHub=_S), licenses=ArrayType(_S)),
    downloads=_struct(all=_L),
)

PROCESSING_STATE = _struct(key=_S, status=_S, error=_S, files=_I, commit_sha=_S, ts=_D)

PROMPT = _struct(messages=MESSAGES, task_type=_S, approach=_S, source_file_id=_S)

RESPONSE = _struct(
    content=_S, finish_reason=_S, wall_time_ms=_L, input_tokens=_L, output_tokens=_L,
    error=_S, error_type=_S,
)

GENERATION_LOG = _struct(
    request_id=_S, provider=_S, model=_S, approach=_S, turn=_I, task_type=_S, source_file_id=_S,
    source_file_path=_S, source_repo=_S, source_stars=_L, timestamp=_S, content=_S,
    finish_reason=_S, wall_time_ms=_L, input_tokens=_L, output_tokens=_L, cached_input_tokens=_L,
    reasoning_tokens=_L, estimated_cost_usd=_D,
    nw_energy=_struct(energy_joules=_D),
    nw_cost=_struct(request_cost_usd=_D, allowance_remaining_usd=_D),
    reasoning=_S, time_info=_S, error=_S, error_type=_S,
)

TRAINING_COLUMNS = [
    "task_type", "source_file_id", "source_file_path", "source_repo", "source_stars", "content",
    "input_tokens", "output_tokens", "provider", "model",
]
TRAINING_ROW = StructType([GENERATION_LOG[c] for c in TRAINING_COLUMNS])

CHAT_RECORD = _struct(
    id=_S, source_file_id=_S, source_repo_url=_S, messages=MESSAGES, task_type=_S,
    source_language=_S, model_used=_S, license=_S, schema_version=_I,
)

MIXED_RECORD = _struct(messages=MESSAGES, source=_S, task_type=_S, language=_S)

SHAREGPT_RECORD = _struct(
    id=_S, conversations=ArrayType(StructType([StructField("from", _S), StructField("value", _S)])),
    language=_S,
)

PAIR_RECORD = _struct(id=_S, input=_S, output=_S, domain=_S)

"""Explicit types of all relations, and fixed constants. Open JSON objects stay JSON text, so that their bytes are kept."""

# Versions, roles, tags, statuses, stages.
FORMAT_VERSION = "anthropic-tools-v1"
STORE_VERSION = "evalstore-v1"
QUEUE_VERSION = "judge-queue-v1"
VERDICTS_VERSION = "judge-verdicts-v1"
CATALOGUE_VERSION = "go-tools-v2"
HARNESS_VERSION = "0.2.0"
ROLES = ("system", "developer", "user", "assistant", "tool")
RESERVED_TAGS = ("<available_tools>", "</available_tools>", "<tool_use>", "</tool_use>", "<tool_result>", "</tool_result>")
STATUSES = ("ok", "tool_error", "model_error", "harness_error")
STAGES = ("generate", "execute", "judge")
VERIFIERS = ("go_test", "go_build")
VISION_PAD = "<|vision_pad|>"
IGNORED_LABEL = -100
MAX_TURNS = 8
MAX_IMAGES = 4


# Types as DDL strings.
IMAGE = "ref string, grid_thw array<int>, merge_size int"
TOOL_SPEC = "name string, description string, input_schema string"
TOOL_CALL = "id string, name string, arguments string"
TOOL_RESULT = "tool_use_id string, content string, is_error boolean"
MESSAGE = "struct<role:string,content:string,reasoning_content:string,tool_calls:array<struct<id:string,name:string,arguments:string>>,results:array<struct<tool_use_id:string,content:string,is_error:boolean>>,images:array<struct<ref:string,grid_thw:array<int>,merge_size:int>>>"
CONVERSATION = f"messages array<{MESSAGE}>, tools array<struct<name:string,description:string,input_schema:string>>"
CODE_PAIR = "sha256 string, repository string, code_path string, code string, code_commit string, test_path string, test string, test_commit string"
MEASURED = "id string, repository string, package string, tools array<string>, supervised_tokens bigint, total_tokens bigint, has_thinking boolean, has_images boolean"
TASK = "id string, repository string, package string, prompt string, verification array<string>, fixture string, has_images boolean, metadata map<string,string>"
TURN = "task_id string, sample_index int, turn_index int, text string, calls array<struct<id:string,name:string,arguments:string>>, results array<struct<tool_name:string,status:string,exit_code:int,stdout:string,duration_ms:bigint,harness_error:string,call_index:int>>"
VERDICT = "version string, key string, score double, reason string"
QUEUE_ENTRY = "version string, key string, task_id string, sample_index int, prompt string, trajectory string"
PAIR = "prompt string, chosen string, rejected string, task_id string, chosen_reward double, rejected_reward double, margin double"
EVENT = "event string, stage string, key string, turn int"
FINDING = "name string, measured double, required double"

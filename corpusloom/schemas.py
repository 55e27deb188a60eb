"""Table schemas and the fixed values every stage of the corpus work shares."""

from __future__ import annotations

from pyspark.sql import types as T

# Special tokens, compatibility vocabulary and label sentinel.
END_OF_TEXT = "<|endoftext|>"
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
USER = "<|user|>"
ASSISTANT = "<|assistant|>"
COMPAT_VOCAB = {END_OF_TEXT: 0, IM_START: 1, IM_END: 2, USER: 3, ASSISTANT: 4}
IGNORE_LABEL = -100
DEFAULT_MAX_LENGTH = 2048

# Tokens the tokenizer declares as special, hence never splits into characters.
# <|im_end|> has an id but is not declared, so text containing it is split.
DECLARED_SPECIALS = (END_OF_TEXT, IM_START)

PROMPT_RESPONSE = T.StructType(
    [
        T.StructField("prompt", T.StringType()),
        T.StructField("response", T.StringType()),
    ]
)

INSTRUCTION_INPUT = T.StructType(
    [
        T.StructField("instruction", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
    ]
)

SYSTEM_USER = T.StructType(
    [
        T.StructField("system_prompt", T.StringType()),
        T.StructField("user_prompt", T.StringType()),
        T.StructField("answer", T.StringType()),
    ]
)

MODEL_INPUT = T.StructType(
    [
        T.StructField("input_ids", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("attention_mask", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("labels", T.ArrayType(T.IntegerType(), False), False),
    ]
)

MESSAGE = T.StructType(
    [
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)
MESSAGES = T.ArrayType(MESSAGE)

CASE = T.StructType(
    [
        T.StructField("test_case", T.IntegerType()),
        T.StructField("messages", MESSAGES),
    ]
)

# A case of several parts has one line for each; the number of a part may be left out for a single one.
CASE_PART = T.StructType(
    [
        T.StructField("test_case", T.IntegerType()),
        T.StructField("part", T.LongType()),
        T.StructField("messages", MESSAGES),
    ]
)

RESULT = T.StructType(
    [
        T.StructField("test_case", T.IntegerType()),
        T.StructField("input", T.StringType()),
        T.StructField("response", T.StringType()),
    ]
)

VOCABULARY = T.StructType(
    [
        T.StructField("token", T.StringType(), False),
        T.StructField("id", T.IntegerType(), False),
    ]
)

CORPUS_SCHEMAS = {
    "prompt_response": PROMPT_RESPONSE,
    "instruction_input": INSTRUCTION_INPUT,
    "system_user": SYSTEM_USER,
}

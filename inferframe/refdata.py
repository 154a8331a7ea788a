"""Reference data used by the request builders and validators.

Everything between the FIXED VALUES markers must stay equal to the behaviour being
reproduced (prompt texts, recognition modes, categories, option defaults, sampling
profiles, tool schema, constraint specs, resize constants). They are plain literals in
natural order; the helpers below turn them into small DataFrames.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------- FIXED VALUES (begin)

# OCR prompt templates, keyed by prompt mode.
OCR_PROMPTS = {
    "prompt_layout_all_en": """Please output the layout information from the PDF image, including each layout element's bbox, its category, and the corresponding text content within the bbox.

1. Bbox format: [x1, y1, x2, y2]

2. Layout Categories: The possible categories are ['Caption', 'Footnote', 'Formula', 'List-item', 'Page-footer', 'Page-header', 'Picture', 'Section-header', 'Table', 'Text', 'Title'].

3. Text Extraction & Formatting Rules:
    - Picture: For the 'Picture' category, the text field should be omitted.
    - Formula: Format its text as LaTeX.
    - Table: Format its text as HTML.
    - All Others (Text, Title, etc.): Format their text as Markdown.

4. Constraints:
    - The output text must be the original text from the image, with no translation.
    - All layout elements must be sorted according to human reading order.

5. Final Output: The entire output must be a single JSON object.
""",
    "prompt_layout_only_en": """Please output the layout information from this PDF image, including each layout's bbox and its category. The bbox should be in the format [x1, y1, x2, y2]. The layout categories for the PDF document include ['Caption', 'Footnote', 'Formula', 'List-item', 'Page-footer', 'Page-header', 'Picture', 'Section-header', 'Table', 'Text', 'Title']. Do not output the corresponding text. The layout result should be in JSON format.""",
    "prompt_ocr": """Extract the text content from this image.""",
    "prompt_grounding_ocr": """Extract text from the given bounding box on the image (format: [x1, y1, x2, y2]).\nBounding Box:\n""",
}

# Recognition modes of the markdown OCR model, and its fixed system instruction.
RECOGNITION_MODES = {
    "text": "Text Recognition:",
    "formula": "Formula Recognition:",
    "table": "Table Recognition:",
}
OCR_SYSTEM_INSTRUCTION = "Recognize the text in the image and output in Markdown format. Preserve the original layout (headings/paragraphs/tables/formulas). Do not fabricate content that does not exist in the image."
OCR_PINNED_MODEL = "zai-org/GLM-OCR"

# Prefix put in front of the prompt for the layout OCR model.
IMAGE_TOKEN_PREFIX = "<|img|><|imgpad|><|endofimg|>"

# Layout categories, in the order the prompt lists them.
LAYOUT_CATEGORIES = [
    "Caption", "Footnote", "Formula", "List-item", "Page-footer", "Page-header",
    "Picture", "Section-header", "Table", "Text", "Title",
]

# Document conversion form defaults (string values), in declaration order.
CONVERSION_DEFAULTS = {
    "target_type": "inbody",
    "to_formats": "md",
    "image_export_mode": "embedded",
    "do_ocr": "true",
    "ocr_engine": "glm-ocr-remote",
    "pipeline": "standard",
    "do_table_structure": "true",
    "include_images": "true",
    "layout_custom_config.kind": "ppdoclayout-v3",
    "vlm_pipeline_preset": "default",
}
# Override sets used with the converter: OCR only, layout only, both, formats list.
CONVERSION_OVERRIDES = {
    "ocr_only": {"ocr_engine": "glm-ocr-remote"},
    "layout_only": {"layout_custom_config": {"kind": "ppdoclayout-v3"}},
    "combined": {"ocr_engine": "glm-ocr-remote",
                 "layout_custom_config": {"kind": "ppdoclayout-v3"}},
    "formats": {"to_formats": ["json", "doctags"]},
}

# Sampling profiles: (profile, family, temperature, top_p, top_k, presence_penalty,
# max_tokens, max_completion_tokens, enable_thinking); None = key absent.
SAMPLING_PROFILES = [
    ("g_think", "chat_a", 1.0, 0.95, 64, None, 81920, None, True),
    ("g_plain", "chat_a", 1.0, 0.95, 64, None, 32768, None, False),
    ("g_json", "chat_a", 1.0, 0.95, 64, None, None, None, True),
    ("g_video_plain", "chat_a", 1.0, 0.95, 64, None, 81920, None, False),
    ("q_think", "chat_b", 1.0, 0.95, 20, 1.5, 81920, None, None),
    ("q_plain", "chat_b", 0.7, 0.8, 20, 1.5, 32768, None, False),
    ("q_json", "chat_b", 1.0, 0.95, 20, 1.5, None, None, None),
    ("q_video_plain", "chat_b", 1.0, 0.95, 20, 1.5, 81920, None, False),
    ("ocr", "ocr", 0.1, 0.9, None, None, None, 32768, None),
]

# Tool registry: the weather tool with its JSON-Schema parameters.
WEATHER_TOOL = {
    "name": "get_current_weather",
    "description": "Get the current weather in a given location",
    "parameters": {
        "type": "object",
        "properties": {
            "city": {
                "type": "string",
                "description": "The city to find the weather for, e.g. 'San Francisco'",
            },
            "state": {
                "type": "string",
                "description": "the two-letter abbreviation for the state that the city is"
                " in, e.g. 'CA' which would mean 'California'",
            },
            "unit": {
                "type": "string",
                "description": "The unit to fetch the temperature in",
                "enum": ["celsius", "fahrenheit"],
            },
        },
        "required": ["city", "state", "unit"],
    },
}
WEATHER_TOOL_RESULT = (
    "The weather in Dallas, Texas is 85 degrees fahrenheit. It is "
    "partly cloudly, with highs in the 90's."
)

# Structured-output constraints.
CHOICES = ["positive", "negative"]
EMAIL_REGEX = r"\w+@\w+\.com\n"
EMAIL_STOP = "\n"
SELECT_GRAMMAR = """
        ?start: select_statement

        ?select_statement: "SELECT " column_list " FROM " table_name

        ?column_list: column_name ("," column_name)*

        ?table_name: identifier

        ?column_name: identifier

        ?identifier: /[a-zA-Z_][a-zA-Z0-9_]*/
    """
SQL_IDENTIFIER = r"[a-zA-Z_][a-zA-Z0-9_]*"
CAR_TYPES = ["sedan", "SUV", "Truck", "Coupe"]

# JSON schemas of the three structured-output classes (fields, required, types).
CAR_DESCRIPTION_SCHEMA = {
    "title": "CarDescription", "type": "object",
    "properties": {"brand": {"type": "string"}, "model": {"type": "string"},
                   "car_type": {"type": "string", "enum": CAR_TYPES}},
    "required": ["brand", "model", "car_type"],
}
CITY_INFO_SCHEMA = {
    "title": "CityInfo", "type": "object",
    "properties": {"city": {"type": "string"}, "population": {"type": "integer"}},
    "required": ["city", "population"],
}
PYTHON_R_CODE_SCHEMA = {
    "title": "PythonRCode", "type": "object",
    "properties": {"cat": {"type": "string"}, "dog": {"type": "string"},
                   "dog_code_number": {"type": "integer"}},
    "required": ["cat", "dog", "dog_code_number"],
}

# Image sizing constants.
IMAGE_FACTOR = 28
MIN_PIXELS = 3136
MAX_PIXELS = 11289600
MAX_ASPECT_RATIO = 200
RENDER_DPI = 200
RENDER_MAX_PIXELS_SIDE = 4500
BASE_DPI = 72

# Batch sizes of the embedding / rerank calls.
EMBED_BATCH_DOCUMENTS = 10
EMBED_BATCH_QUERIES = 4
RERANK_DOCUMENTS = 10

# Task status values of the asynchronous transcription API.
TASK_SUCCESS = "success"
TASK_FAILURE = "failure"
TASK_POLL_SECONDS = 5

# ---------------------------------------------------------------- FIXED VALUES (end)


def prompts_df(spark: SparkSession) -> DataFrame:
    """(mode, template, family) for the 4 OCR templates and the 3 recognition modes."""
    rows = [(k, v, "layout_ocr") for k, v in OCR_PROMPTS.items()]
    rows += [(k, v, "markdown_ocr") for k, v in RECOGNITION_MODES.items()]
    return spark.createDataFrame(rows, "mode string, template string, family string")


def profiles_df(spark: SparkSession) -> DataFrame:
    schema = ("profile string, family string, temperature double, top_p double, top_k int, "
              "presence_penalty double, max_tokens int, max_completion_tokens int, "
              "enable_thinking boolean")
    return spark.createDataFrame(SAMPLING_PROFILES, schema)


def tool_registry_df(spark: SparkSession, extra: list[tuple[str, str, dict]] | None = None
                     ) -> DataFrame:
    """(name, description, params_schema JSON text)."""
    rows = [(WEATHER_TOOL["name"], WEATHER_TOOL["description"],
             json.dumps(WEATHER_TOOL["parameters"]))]
    for name, desc, params in extra or []:
        rows.append((name, desc, json.dumps(params)))
    return spark.createDataFrame(rows, "name string, description string, params_schema string")


def categories_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, c) for i, c in enumerate(LAYOUT_CATEGORIES)],
                                 "cat_idx int, category string")


CHUNK_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("content", T.StringType()),
    T.StructField("finish_reason", T.StringType()),
    T.StructField("created", T.LongType()),
    T.StructField("ts", T.TimestampType()),
])

"""Fixed values the request builders depend on."""

import json

from inferframe import refdata as R


def test_prompts_and_modes():
    assert list(R.OCR_PROMPTS) == ["prompt_layout_all_en", "prompt_layout_only_en",
                                   "prompt_ocr", "prompt_grounding_ocr"]
    assert R.OCR_PROMPTS["prompt_grounding_ocr"].endswith("Bounding Box:\n")
    assert R.OCR_PROMPTS["prompt_ocr"] == "Extract the text content from this image."
    assert R.RECOGNITION_MODES == {"text": "Text Recognition:", "formula": "Formula Recognition:",
                                   "table": "Table Recognition:"}
    assert R.IMAGE_TOKEN_PREFIX == "<|img|><|imgpad|><|endofimg|>"


def test_categories_listed_in_prompt():
    assert len(R.LAYOUT_CATEGORIES) == 11
    listed = "['" + "', '".join(R.LAYOUT_CATEGORIES) + "']"
    assert listed in R.OCR_PROMPTS["prompt_layout_all_en"]
    assert listed in R.OCR_PROMPTS["prompt_layout_only_en"]


def test_conversion_defaults_and_overrides():
    assert len(R.CONVERSION_DEFAULTS) == 10
    assert R.CONVERSION_DEFAULTS["layout_custom_config.kind"] == "ppdoclayout-v3"
    assert set(R.CONVERSION_OVERRIDES) == {"ocr_only", "layout_only", "combined", "formats"}


def test_profiles():
    assert len(R.SAMPLING_PROFILES) == 9
    p = {r[0]: r for r in R.SAMPLING_PROFILES}
    assert p["g_think"][2:] == (1.0, 0.95, 64, None, 81920, None, True)
    assert p["q_plain"][2:] == (0.7, 0.8, 20, 1.5, 32768, None, False)
    assert p["ocr"][2:] == (0.1, 0.9, None, None, None, 32768, None)


def test_tool_schema():
    params = R.WEATHER_TOOL["parameters"]
    assert params["required"] == ["city", "state", "unit"]
    assert params["properties"]["unit"]["enum"] == ["celsius", "fahrenheit"]
    json.dumps(R.WEATHER_TOOL)


def test_constants():
    assert (R.IMAGE_FACTOR, R.MIN_PIXELS, R.MAX_PIXELS, R.MAX_ASPECT_RATIO) == (28, 3136, 11289600, 200)
    assert R.CAR_TYPES == ["sedan", "SUV", "Truck", "Coupe"]
    assert R.EMAIL_REGEX == "\\w+@\\w+\\.com\\n"

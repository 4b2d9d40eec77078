from millrace.functions import chat
from millrace.operators import formatting
from millrace.sources import schemas


def raw(spark, **values):
    names = [c.split()[0] for c in schemas.RAW_MIXED.split(", ")]
    return spark.createDataFrame([tuple(values.get(n) for n in names)], schemas.RAW_MIXED)


def test_support_record_is_trimmed(spark):
    df = raw(spark, row_id=1, domain="support", ticket="  The loom will not start.\n", resolution="Reset the belt.")
    out = formatting.format_records(df).first()
    assert out.input == "The loom will not start." and out.output == "Reset the belt."
    assert "support reply" in out.instruction
    assert formatting.format_records(df).columns == ["row_id", "domain", "instruction", "input", "output"]


def test_unknown_domain_blank_or_missing_text_drops_out(spark):
    assert formatting.format_records(raw(spark, row_id=1, domain="cooking", ticket="a", resolution="b")).count() == 0
    assert formatting.format_records(raw(spark, row_id=1, domain="support", ticket=" ", resolution="b")).count() == 0
    assert formatting.format_records(raw(spark, row_id=1, domain="support", ticket="a")).count() == 0
    assert formatting.format_records(raw(spark, row_id=1, ticket="a", resolution="b")).count() == 0


def test_values_of_other_types_are_no_text(spark):
    kinds = "row_id bigint, domain string, ticket int, resolution string"
    df = spark.createDataFrame([(1, "support", 5, "Reset the belt.")], kinds)
    assert formatting.format_records(df).count() == 0


def example(spark, input_="three bolts"):
    return spark.createDataFrame(
        [(1, "legal", "Name the cloth.", input_, "It is twill.")],
        "row_id bigint, domain string, instruction string, input string, output string",
    )


def test_messages(spark):
    row = formatting.with_messages(example(spark)).first()
    assert [m.role for m in row.messages] == ["user", "assistant"]
    assert row.messages[0].content == "Name the cloth.\n\nthree bolts"
    assert len(formatting.with_messages(example(spark), include_answer=False).first().messages) == 1


def test_input_may_be_missing_empty_or_blank(spark):
    for given, expected in ((None, "Name the cloth."), ("", "Name the cloth."), (" ", "Name the cloth.\n\n ")):
        assert formatting.with_user_message(example(spark, given)).first().user_message == expected


def test_chat_text_loses_its_start_mark_and_prompts_keep_it(spark):
    text = formatting.training_texts(example(spark)).first()
    assert text.asDict() == {"row_id": 1, "text": "[INST] Name the cloth.\n\nthree bolts[/INST] It is twill.</s>"}
    prompt = formatting.generation_prompts(example(spark)).first().prompt
    assert prompt == "<s>[INST] Name the cloth.\n\nthree bolts[/INST]"
    llama = formatting.generation_prompts(example(spark), "llama3").first().prompt
    assert llama.startswith("<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\nName the cloth.")
    assert llama.endswith("<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n")


def test_only_one_start_mark_is_removed(evaluate):
    assert evaluate(chat.drop_bos, "<s><s>x") == "<s>x"
    assert evaluate(chat.drop_bos, "x<s>") == "x<s>"

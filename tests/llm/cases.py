"""Edge rows shared by the tests of this folder."""

SF = "/root/testdata/sf0.001"

ODD_TEXTS = [
    None, "", " ", "   ", "a", "\n", "x" * 3000, "a  b   c\n\n d\t e ", "café café ́x", "it's we'll 's 'S  's",
    "<|endoftext|> <|startoftext|>a<|endoftext|>b", " x   y　z  ", "你好 世界 123 4567",
    "İstanbul ΣΑΣ \U0001f600\U0001f600 ok", "▁a ▁ ▁▁b a▁ c", "a\x00b \x1c \x85 c",
    "tab\tand\x0bvt\x0cff\r\nend ", "<\\|im_end\\|> <|im_start|><\\\\|x|>", "dup text row", "dup text row",
]


def documents(spark, texts=ODD_TEXTS, extra=True):
    rows = [(i, t, None, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens long")
    return df if extra else df.drop("n_tokens")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")

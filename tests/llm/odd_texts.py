#: nulls, empty, blank, one word, control strings, other alphabets and a very long text
ODD = [None, "", " \n\t ", "word", "two  words\n", "<|im_end|> <s> </s>", "日本語 テキスト ▁ é́", "a" * 30000,
       "lorem ipsum dolor sit amet " * 4000, "word"]

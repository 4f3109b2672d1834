"""Licence notices beside common words and wrapped over lines."""

from courierlake.llm import licenses


def test_common_words_and_wrapped_notices(spark):
    plain = [(i, f"d/{i}", "tion stone house of green water under seven light") for i in range(400)]
    files = plain + [
        (900, "a/x", "tion released under the MIT License"),
        (901, "b/x", "some words\nRedistribution and use in source and binary forms, with or without\nmodification, are "
                     "permitted provided that the following conditions are met\nother words"),
        (902, "c/x", "Head\n\nThis program is free software: you can redistribute it and/or modify\nit under the terms of "
                     "the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of "
                     "the License, or\n(at your option) any later version.\n\nBody of the text, " + "green water " * 50)]
    df = spark.createDataFrame(files, "id long, path string, text string")
    got = {r["id"]: r["license"] for r in licenses.scan(df).collect() if r["license"]}
    assert got == {900: "MIT", 901: "BSD-3-Clause", 902: "GPL-3.0"}

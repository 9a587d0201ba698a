"""Command line over a stored index: python -m ledgerloom FOLDER search|suggest|fetch|exact TEXT, or traverse ROUTE. Answers are JSON lines."""

from __future__ import annotations

import argparse
import json
import sys


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerloom", description=__doc__)
    parser.add_argument("folder", help="folder of the tables")
    parser.add_argument("tool", choices=["search", "suggest", "fetch", "exact", "traverse"])
    parser.add_argument("text")
    parser.add_argument("--master", default="local[*]")
    parser.add_argument("--limit", type=int, default=20)
    asked = parser.parse_args(arguments)

    from ledgerloom.operators.stored import traverse, write_adjacency
    from ledgerloom.plans.relations import trade_edges
    from ledgerloom.plans.text_search import _index
    from ledgerloom.session import build_session, stored, table

    spark = build_session(asked.master)
    if asked.tool == "traverse":
        path = stored("adjacency", table(spark, asked.folder, "lineitem").select("l_orderkey"), lambda to: write_adjacency(trade_edges(spark, asked.folder), to))
        answer = traverse(spark, path, asked.text).limit(asked.limit)
    else:
        own = _index(spark, asked.folder)
        if asked.tool == "fetch":
            try:
                print(json.dumps(own.fetch(asked.text), ensure_ascii=False, default=str))
                return 0
            except LookupError as problem:
                print(problem, file=sys.stderr)
                return 1
        if asked.tool == "search":
            answer = own.search(spark.createDataFrame([(1, asked.text)], "query_id int, text string"), asked.limit)
        elif asked.tool == "suggest":
            answer = own.suggest(spark.createDataFrame([(asked.text,)], "word string"))
        else:
            answer = own.exact([asked.text], ["open", "url", "content_id", "title_key"]).limit(asked.limit)
    for line in answer.toJSON().collect():  # at most `limit` rows
        print(line)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

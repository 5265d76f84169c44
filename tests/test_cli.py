import json

import pytest

from paylake.__main__ import main


def test_from_messages_to_an_answer(spark, folder):
    import os

    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/1.txt", "w") as file:
        for number in range(20):
            payload = {
                "transaction_id": f"t{number}", "user_id": "u", "amount": number, "currency": "EUR",
                "transaction_type": "DEBIT", "status": ["COMPLETED", "FAILED"][number % 2],
            }
            at = f"2026-02-{11 + number % 2}T{number:02d}:00:00.000"
            file.write(json.dumps({"source": "faker", "received_at": at, "payload": payload}) + "\n")
        file.write("junk\n")
    main(["ingest", "--folder", f"{folder}/in", "--raw", f"{folder}/raw", "--rejects", f"{folder}/rejects",
          "--checkpoints", f"{folder}/checkpoints", "--drain"])
    days = ["--start", "2026-02-11", "--end", "2026-02-12"]
    main(["merge", "--raw", f"{folder}/raw", "--now", "2100-01-01T00:00:00", *days])
    window = [*days, "--sources", "faker"]
    main(["process", "--from", f"{folder}/raw", "--to", f"{folder}/processed", "--rejects", f"{folder}/malformed", *window])
    scheduled = ["--scheduled", "--now", "2026-02-11T03:10:00", "--sources", "faker", "--ignore-corrupt"]
    main(["process", "--from", f"{folder}/raw", "--to", f"{folder}/processed", *scheduled])
    main(["compact", "--from", f"{folder}/processed", "--to", f"{folder}/analytics", *window])
    main(["query", "SELECT count(*) AS n, sum(amount) AS total FROM faker()", "--alias",
          f"faker={folder}/analytics/tb-faker/**/*.parquet", "--out", f"{folder}/answer"])
    assert tuple(spark.read.parquet(f"{folder}/answer").first()) == (10, 90.0)
    assert spark.read.parquet(f"{folder}/rejects").count() == 1


def test_a_window_is_needed(spark, folder):
    with pytest.raises(ValueError):
        main(["process", "--from", folder, "--to", folder])

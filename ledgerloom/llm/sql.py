"""SQL of the text problems' queries, where SQL can express them: decoding the ids must give back every text."""

SQL = {"p8_decoded": "SELECT doc_id, text FROM documents"}

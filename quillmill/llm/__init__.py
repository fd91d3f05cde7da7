"""Training-data operators: packing, quality, secrets, duplicates, WARC, licences, language model, decontamination."""

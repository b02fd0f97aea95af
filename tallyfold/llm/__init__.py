"""Training-data operators: quality, packing, language, decontamination, toxicity, duplicates, chat, scans."""

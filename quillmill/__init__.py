"""quillmill: Spark jobs that prepare conversational and prose training data."""

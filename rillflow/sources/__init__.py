"""Readers of gauge files. They read text through Spark, so any store that Spark opens will do."""

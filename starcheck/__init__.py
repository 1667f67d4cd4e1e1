"""Check harness: binds the library to the driver's star-schema tables and states the expected results in SQL."""

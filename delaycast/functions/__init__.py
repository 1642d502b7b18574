"""SQL expressions over column names. All are native functions and stay inside generated code."""

"""Operators that turn raw text into training data. Nothing outside this subpackage imports it."""

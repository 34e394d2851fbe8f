"""Tests of aerolap.llm."""

"""gristmill.streaming"""
